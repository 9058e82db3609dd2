"""Hard negatives, lattice scores and the prefix trie against brute force, on
small tables with nulls, ties, repeated rows, long groups, clashing names."""

import collections
import hashlib
import math
import random
import re
import zlib
from decimal import Decimal
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatio.llm import hard_negatives, lattice, lattice_lm, prefix_trie, registry, running
from curatio.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ----------------------------------------------------------- running sums

@pytest.mark.parametrize("group", ["g", None])
def test_running_sums_wrap_and_restart_at_groups(spark, group):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4]), k, rng.randrange(-2 ** 63, 2 ** 63), 1) for k in range(700)]
    df = spark.createDataFrame(rows, "g long, k long, x long, one long").repartition(5)
    got = running.running(df, ["g", "k"] if group else ["k"], ["x", "one"], Scratch(spark, "t"), "s", group=group).collect()
    wrap = lambda v: (v + 2 ** 63) % 2 ** 64 - 2 ** 63
    total = collections.defaultdict(int)
    count = collections.Counter()
    want = {}
    for g, k, x, _ in sorted(rows, key=lambda r: r[:2] if group else r[1]):
        at = g if group else 0
        before = total[at]
        total[at] += x
        count[at] += 1
        want[k] = (wrap(before), wrap(total[at]), count[at] - 1)
    assert {r.k: (r.x_before, r.x_upto, r.one_before) for r in got} == want


# ------------------------------------------------------------ prefix trie

def trie_brute(turns):
    """From {conv_id: [(role, text), ...]} in order of turns."""
    built = {}
    for c, own in turns.items():
        b = c - int(math.fmod(c, 20))
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own) if b == c else tuple(turns.get(b, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k in members:
        own = (len(members[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += own
    sha = lambda k: hashlib.sha256(",".join(
        str(c) for c in sorted(members[k]) if len(built[c]) == len(k)).encode()).hexdigest()
    return sorted([(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], sha(k))
                   for k, m in members.items()], key=str)


TRIE = "conv_id long, turn long, role string, text string, id long, k1 string, words string"


def trie_rows(rng):
    turns = collections.defaultdict(list)
    for c in [*range(0, 90), -7, -20, -33, 10 ** 12]:
        n = rng.randrange(0, 7) if c != 41 else 300
        turns[c] = [(rng.choice(["user", "assistant"]), rng.choice(["a b", "a", "c d e", "\t x\n y "])) for _ in range(n)]
    for c in range(50, 60):
        turns[c] = list(turns[41][:5])                          # a group of copies
    turns[3] = [("", ""), ("user", "")]
    rows = []
    for c, own in turns.items():
        for i, (r, t) in enumerate(own):
            rows.append((c, i if i or c % 3 else None, r or None, t or None, 9, "k", "w"))
    rng.shuffle(rows)
    return {c: t for c, t in turns.items() if t}, rows + [(None, 1, "user", "no id", 9, "k", "w")]


def test_trie_equals_brute_force(spark):
    turns, rows = trie_rows(random.Random(8))
    df = spark.createDataFrame(rows, TRIE).repartition(4)
    for rules in (prefix_trie.TrieRules(), prefix_trie.TrieRules(base=32, piece=3)):
        got = prefix_trie.prefix_trie(df, rules)
        assert all(t == "bigint" for c, t in got.dtypes if c != "ends_sha256")
        assert sorted(map(tuple, got.collect()), key=str) == trie_brute(turns)
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0


def test_trie_of_repeated_rows_and_ties(spark):
    rows = [(5, 0, "user", "same", 1, "", "")] * 3 + [(6, 0, "user", "x", 1, "", ""), (6, 0, "user", "y", 1, "", "")]
    df = spark.createDataFrame(rows, TRIE)
    order = [r.text for r in df.filter("conv_id = 6").orderBy(F.xxhash64("role", "text")).collect()]
    got = prefix_trie.prefix_trie(df, prefix_trie.TrieRules()).collect()
    want = trie_brute({5: [("user", "same")] * 3, 6: [("user", t) for t in order]})
    assert sorted(map(tuple, got), key=str) == want
    lone = spark.createDataFrame([(39, 0, "user", "x", 1, "", "")], TRIE)      # its first turn is not taken: turnless
    assert [r.n_convs for r in prefix_trie.prefix_trie(lone).collect()] == [1] * (1 + (zlib.crc32(b"39") % 4 == 0))


def test_list_rank_of_a_shuffled_list(spark):
    rng = random.Random(4)
    order = list(range(500))
    rng.shuffle(order)
    rows = [(a, order[k - 1] if k else None, order[k + 1] if k + 1 < len(order) else None) for k, a in enumerate(order)]
    arcs = spark.createDataFrame(rows, "arc long, prev long, next long")
    got = prefix_trie.list_rank(arcs, prefix_trie.TrieRules(base=10), Scratch(spark, "t")).collect()
    assert {r.arc: len(order) - 1 - r.after for r in got} == {a: k for k, a in enumerate(order)}


# --------------------------------------------------------- hard negatives

VEC = "vec_id long, embedding array<float>, label int, id long, v string, score string, block long"


def negatives_brute(rows, low=30, high=90):
    table = set()
    for i, v, y, *_ in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        table.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, y, v in table:
        if i % 100:
            continue
        scored = sorted({(-dot(v, w), j, z == y) for j, z, w in table if j != i})
        for p, j, _ in [s for s in scored if s[2]][:5]:
            fit = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p][:10]
            out += [(i, j, k + 1, s[1], -p, -s[0]) for k, s in enumerate(fit)]
    return sorted(out)


def vec_rows(rng):
    def vec(size):
        return [rng.gauss(0, 1) * size for _ in range(6)]
    rows = [(i, vec(rng.choice([0.01, 0.2, 1, 1, 30])), rng.randrange(4)) for i in range(600)]
    rows += [(700, None, 1), (800, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (900, [float("nan")] * 6, 1), (1000, [1.0] * 6, None),
             (1100, [0.0] * 6, 1), (1101, [0.0] * 6, 2), (None, [1.0] * 6, 1), (1200, [1.0, 2.0], 1), (1201, [], 2),
             (1300, [float("inf")] + [0.0] * 5, 2)]
    rows += [(i, list(rows[0][1]), rng.randrange(4)) for i in range(2000, 2040)]       # equal vectors: ties
    rows += [rows[3]] * 5 + [rows[100]] * 2
    return [(*r, 1, "v", "s", 2) for r in rows]


def test_hard_negatives_equal_brute_force(spark):
    rows = vec_rows(random.Random(11))
    df = spark.createDataFrame(rows, VEC).repartition(3)
    label = F.when(df["vec_id"] % 7 == 0, (df["label"] + 1) % 10).otherwise(df["label"])
    for rules in (hard_negatives.MiningRules(), hard_negatives.MiningRules(block=32, queries=4, focus=3)):
        got = hard_negatives.hard_negatives(df, df["vec_id"] % 100 == 0, rules, label=label)
        assert sorted(map(tuple, got.collect())) == negatives_brute(rows)
    empty = hard_negatives.hard_negatives(df.limit(0), df["vec_id"] % 100 == 0, label=label)
    assert empty.count() == 0


def test_feasible_ranges_never_lose_a_row_and_do_prune():
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(800, 12)) * 100 * np.exp(-np.arange(12))).round().astype(np.int64)
    length = np.sqrt((v ** 2).sum(1))
    block = hard_negatives.Block(np.arange(800), np.zeros(800, int), v, length, 12, 5)
    kept = 0
    for i in range(0, 800, 10):
        s = v @ v[i]
        low, high = int(np.quantile(s, 0.97)), int(np.quantile(s, 0.99))
        rows = block.feasible(v[i], length[i], low, high)
        assert set(np.flatnonzero((s >= low) & (s <= high))) <= set(rows.tolist())
        kept += len(rows)
    assert kept < 0.7 * 80 * 800


@pytest.mark.parametrize("top", [30, 1 << 12, 1 << 30])
def test_bands_of_an_anchor_are_scored_once(top, monkeypatch):
    """Whole blocks where ranges prune nothing, in one product for many anchors,
    whatever their bands; exact at any size of the components."""
    rng = np.random.default_rng(9)
    v = rng.integers(-top, top, (900, 16))
    labels, ids = rng.integers(0, 3, 900), rng.permutation(450).repeat(2)
    block = hard_negatives.Block(ids, labels, v, np.sqrt((v.astype(float) ** 2).sum(1)), 16, 4)
    calls = collections.Counter()
    for name in ("feasible", "scored"):
        plain = getattr(hard_negatives.Block, name)
        monkeypatch.setattr(hard_negatives.Block, name,
                            lambda self, *a, name=name, plain=plain: (calls.update([name]), plain(self, *a))[1])
    exact = v.astype(object) @ v[:200].T.astype(object)
    cut = [int(np.quantile(exact[:, i].astype(float), 0.6)) for i in range(200)]
    bands = [[(None, None), (c, None), (c // 2, 2 * c), (None, c)] for c in cut]
    for same in (True, False):
        calls.clear()
        got = block.best(v[:200], block.lengths[:200], list(zip(labels[:200].tolist(), ids[:200].tolist())), same, bands, 5)
        for i in range(200):
            rows = [j for j in range(900) if (labels[j] == labels[i]) == same and ids[j] != ids[i]]
            for (low, high), found in zip(bands[i], got[i]):
                fit = sorted((-exact[j, i], ids[j]) for j in rows
                             if (low is None or exact[j, i] >= low) and (high is None or exact[j, i] <= high))
                assert found == [(-a, b) for a, b in fit[:5]]
        assert calls["feasible"] == 200 and calls["scored"] <= 2


def test_scores_of_any_size_are_exact():
    for top in (10, 1 << 30, 1 << 62):
        v = np.array([[top, -top, 3], [top, top, -1]], np.int64)
        got = hard_negatives._score(v, np.array([top, 5, 7], np.int64), float(top) * top)
        want = [min(max(top * top - 5 * top + 21, -2 ** 63), 2 ** 63 - 1), min(top * top + 5 * top - 7, 2 ** 63 - 1)]
        assert got.tolist() == want


# ----------------------------------------------------------------- lattice

@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces(registry.vocabulary("piece_bpe_32k.model"))


@cache
def usable_pieces():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=registry.vocabulary("piece_bpe_32k.model"))
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}


def marginal(pieces, w, word):
    """All segmentations, by plain recursion over probabilities."""
    usable = usable_pieces()
    s = "▁" + word
    a = [Decimal(1)] + [Decimal(0)] * len(s)                # no underflow in long words
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - pieces.longest), j):
            if s[i:j] in usable:
                a[j] += a[i] * Decimal(math.exp(w[usable[s[i:j]]]))
        a[j] += a[j - 1] * Decimal(math.exp(sum(w[pieces.byte[b]] for b in s[j - 1].encode())))
    return float(a[-1].ln())


WORDS = ["the", "hello", "naïve", "日本語", "x", "a" * 30, "internationalization" * 3, "|", "\u0000", "é", "▁▁", "\U0001F600"]


def test_lattice_marginals_equal_recursion(pieces):
    w = pieces.first_weights()
    got, _ = lattice.Lattice(pieces, w).run(WORDS)
    assert got == pytest.approx([marginal(pieces, w, x) for x in WORDS], rel=1e-9)


def test_expected_uses_equal_the_gradient(pieces):
    w, words = pieces.first_weights(), [*WORDS, "hello"]
    got, uses = lattice.Lattice(pieces, w).run(words, np.arange(1.0, len(words) + 1))
    e = 1e-6
    for i in np.argsort(-uses)[:12]:
        more = w.copy()
        more[i] += e
        moved, _ = lattice.Lattice(pieces, more).run(words)
        assert uses[i] == pytest.approx(((moved - got) / e) @ np.arange(1.0, len(words) + 1), rel=1e-3)


def test_starts_are_followed_only_as_far_as_pieces_go_on(pieces, monkeypatch):
    """Look-ups grow with the pieces that words hold, not with all their parts."""
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(30)) for _ in range(500)] + WORDS
    seen, find = [], lattice.Pieces.find
    monkeypatch.setattr(lattice.Pieces, "find", lambda self, h: (seen.append(h.size), find(self, h))[1])
    grid, w = lattice.Lattice(pieces, pieces.first_weights()), pieces.first_weights()
    got, uses = grid.run(words, np.ones(len(words)))
    assert sum(seen) < 5 * sum(len(x) + 1 for x in words)
    assert got[::25] == pytest.approx([marginal(pieces, w, x) for x in words[::25]], rel=1e-9)
    assert grid.run(words)[0] == pytest.approx(got, rel=1e-12)
    alone = [grid.run([x], np.ones(1))[1] for x in words]
    assert uses == pytest.approx(sum(alone), rel=1e-9, abs=1e-12)         # whatever words are computed together


DOCS = "doc_id long, text string, word string, n long, lp string, key long"


def test_document_scores_equal_brute_force(spark, pieces):
    rng = random.Random(6)
    vocab = ["the", "The", "of", "zebra", "naïve", "日本", "word" * 20, "|"]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t"), (None, "no id the"), (103, "rare one once"), (0, rows[0][1]),
             (104, "y" * 3000), (None, None)]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    df = spark.createDataFrame([(i, t, "w", 1, "lp", 3) for i, t in rows], DOCS).repartition(3)
    rules = lattice_lm.LatticeRules(registry.vocabulary("piece_bpe_32k.model"), rounds=1, frequent=6)
    got = lattice_lm.score_documents(df, held, rules).collect()
    assert len(got) == len(rows)

    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter()
    for i, t in rows:
        if not out(i):
            c.update([*WORD.findall(lower(t)), None])
    n, v = sum(c.values()), len(c)
    known = [x for x in c if x is not None]
    _, uses = lattice.Lattice(pieces, pieces.first_weights()).run(known, np.array([float(c[x]) for x in known]))
    total = uses[:-1][pieces.used].sum() + 0.1 * len(pieces.used) + c[None] + 0.1
    w = np.full(pieces.size, -np.inf)
    w[pieces.used] = np.log((uses[:-1][pieces.used] + 0.1) / total)
    end = math.log10((c[None] + 0.1) / total)
    assert np.exp(w).sum() + 10 ** end == pytest.approx(1.0)
    known_marginal = cache(lambda x: marginal(pieces, w, x))
    want = collections.Counter()
    for i, t in rows:
        words = WORD.findall(lower(t))
        tokens = [*words, None]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens)
        score = end + sum(known_marginal(x) for x in words) / math.log(10)
        want[i, out(i), len(tokens), sum(c[x] > 0 for x in tokens), n, round(base, 6), round(score, 6)] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6),
                                round(r.score, 6)) for r in got) == want
    assert lattice_lm.score_documents(df.limit(0), held, rules).count() == 0


def test_scores_without_training_documents(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    r = lattice_lm.score_documents(df, F.lit(True), lattice_lm.LatticeRules(registry.vocabulary("piece_bpe_32k.model"))).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0) and r.score < 0
