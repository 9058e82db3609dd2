"""Each operator against a brute-force statement of its result, on small
tables with nulls, empty and long texts, ties, repeated rows, clashing names."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatio.llm import (arc_warc, bpe_automaton, components, fertility, jaccard_join, langid, learned_ann, licenses,
                         line_dedup, link_trust, packing, registry)
from curatio.llm.scratch import Scratch, scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, n_words long, h long, bits string"


def docs(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", 5, 7, "x") for i, t in rows], SCHEMA)


ODD = [(900, None), (901, ""), (902, " \t\n"), (903, "a\n\n\nb"), (None, "no id " * 30), (None, None), (904, "é" * 5000),
       (905, "same row twice " * 20), (905, "same row twice " * 20)]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def edits(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


# ---------------------------------------------------------------- packing

def test_packing_places_every_word_once(spark):
    rng = random.Random(1)
    rules = packing.PackRules(lengths=(8, 16, 32), shard_pieces=64)
    rows = [(i, "w " * rng.randrange(0, 90)) for i in range(200)] + ODD
    got = packing.pack(docs(spark, rows), rules).collect()
    for i, t in rows:
        mine = sorted([r for r in got if r.doc_id == i and r.n_words == len(WORD.findall(t or ""))], key=lambda r: r.piece)
        if not WORD.findall(t or ""):
            assert [r.bin_id for r in mine][:1] == [None]
        elif i not in (905, None):
            assert sum(r.n_places for r in mine) == len(WORD.findall(t)) + 1
            assert [r.start_word for r in mine] == [32 * k for k in range(len(mine))]
    bins = {}
    for r in got:
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for rs in bins.values():
        used, at = sum(r.n_places for r in rs), 0
        for r in sorted(rs, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_places
        assert {r.bin_size for r in rs} == {min(s for s in rules.lengths if s >= used)}      # downsized
    assert packing.pack(docs(spark, rows).limit(0), rules).count() == 0


def test_packing_is_best_fit_and_not_dearer_than_one_size():
    rules = packing.PackRules(lengths=(8, 16))
    assert packing.pack_pieces([9, 6, 5, 3], rules)[0] == [0, 0, 1, 1]       # 6 fits 9's rest best
    rng = random.Random(2)
    for _ in range(30):
        lengths = sorted((rng.randrange(1, 17) for _ in range(40)), reverse=True)
        cost = lambda where, size: sum(s + rules.bin_cost for s in dict(zip(where, size)).values())
        where, _, size = packing.pack_pieces(lengths, rules)
        for one in ((16,),):
            w1, _, s1 = packing.pack_pieces(lengths, packing.PackRules(lengths=one))
            assert cost(where, size) <= cost(w1, s1)


# ------------------------------------------------------------- link trust

def test_hosts_paths_and_rules(spark):
    urls = ["HTTP://WWW.Example.com/en/x?q#f", "https://a.net/es/1", "x://b.org", "y://c.net?/es/", None, "no scheme",
            "http://example.com/en/", "http://notexample.com/en/", "http://com/", "z://://"]
    df = spark.createDataFrame([(k, u, "<a href='//t.org/1'>", "clash") for k, u in enumerate(urls)],
                               "page_id long, url string, html string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in link_trust.judge_urls(df).collect()}
    assert got[0] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[1] == ("a.net", "/es/1", "net/es/", "block")
    assert got[2][:3] == ("b.org", "", None) and got[3][:3] == ("c.net", "", None)
    assert got[4][:3] == got[5][:3] == ("", "", None)
    assert got[6][2:] == ("example.com/en/", "block")
    assert got[7][2:] == ("com/", "allow") and got[8][2:] == ("com/", "allow")
    assert got[9][:2] == (":", "//")
    assert link_trust.judge_urls(df.limit(0)).count() == 0


def solved_rank(edges, seeds, damping):
    """The settled ranks, from the linear system that they solve."""
    hosts = sorted(seeds)
    at = {h: k for k, h in enumerate(hosts)}
    home = np.array([seeds[h] for h in hosts])
    home = home / home.sum()
    step = np.zeros((len(hosts), len(hosts)))
    for h in hosts:
        to = [b for a, b in edges if a == h]
        for b in to:
            step[at[b], at[h]] += 1 / len(to)
        if not to:
            step[:, at[h]] = home
    return dict(zip(hosts, np.linalg.solve(np.eye(len(hosts)) - damping * step, (1 - damping) * home)))


def graphs():
    rng = random.Random(3)
    hosts = [f"h{k}" for k in range(12)]
    some = sorted({(a, b) for a, b in ((rng.choice(hosts), rng.choice(hosts)) for _ in range(25)) if a != b})
    yield some, {h: float(k % 3 == 0) for k, h in enumerate(hosts)}
    chain = [f"h{k:02}" for k in range(15)]                       # the last host is 14 links from the seed
    yield list(zip(chain, chain[1:])), {h: float(h == "h00") for h in chain}
    spokes = [f"s{k}" for k in range(30)]                         # all link to a hub, the hub links to a few
    yield [(s, "hub") for s in spokes] + [("hub", s) for s in spokes[:3]], {"hub": 0.0} | {s: float(k % 2) for k, s in enumerate(spokes)}


@pytest.mark.parametrize("graph", range(3))
def test_rank_settles_at_the_solved_system(spark, graph):
    edges, seeds = list(graphs())[graph]
    cfg = link_trust.TrustRules(tolerance=1e-6)
    want = solved_rank(edges, seeds, cfg.damping)
    got = link_trust.personalised_rank(spark.createDataFrame(edges, "src string, dst string"),
                                       spark.createDataFrame(list(seeds.items()), "host string, weight double"),
                                       cfg, Scratch(spark, "t"), "t")
    rows = got.collect()
    assert len(rows) == len(seeds)
    for r in rows:
        assert r["rank"] == pytest.approx(want[r.host], abs=1e-5)
        assert r["rank"] > 0 or want[r.host] == 0


def test_trust_rules_refuse_what_never_settles():
    with pytest.raises(ValueError):
        link_trust.TrustRules(tolerance=0.0)
    with pytest.raises(ValueError):
        link_trust.TrustRules(damping=1.0)


def test_distrust_reaches_who_links_to_blocked_hosts(spark):
    rows = [(k, f"http://bad.net/es/{k}", "") for k in range(4)]
    rows += [(10 + k, f"http://friend.org/{k}", '<a href="http://BAD.net/es/1">x</a>') for k in range(2)]
    rows += [(20 + k, f"http://fine{k}.org/", "") for k in range(6)]
    got = {r.host: r.verdict for r in link_trust.judge_urls(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got["friend.org"] == "block" and all(got[f"fine{k}.org"] == "allow" for k in range(6))


# ----------------------------------------------------------- jaccard join

def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t))
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("seed,block", [(1, 4), (2, 512)])
def test_jaccard_components_equal_brute_force(spark, seed, block):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(220):
        if rows and rng.random() < 0.7:
            w = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randrange(0, 3)):
                p = rng.randrange(max(1, len(w)))
                w[p:p + 1] = [rng.choice(vocab).upper()] if rng.random() < 0.6 else []
            w = w or ["x"]
        else:
            w = [rng.choice(vocab) for _ in range(rng.choice([2, 4, 5, 8, 40, 120]))]
        rows.append((k, " ".join(w)))
    named = [(i, t) for i, t in rows + ODD if i is not None]
    got = jaccard_join.jaccard_components(docs(spark, rows + ODD), jaccard_join.JoinRules(block=block)).collect()
    assert len(got) == len(rows + ODD)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert {i: found[i] for i, _ in named} == brute_components(named)


def test_one_of_each_group_stays(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(3, text), (1, text.upper()), (2, "something else that is quite different from it"), (2, None), (5, text), (1, text.upper())]
    kept = jaccard_join.one_of_each(docs(spark, rows))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(r.doc_id for r in kept.collect() if r.text) == [1, 2]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (100, 100)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges, Scratch(spark, "t")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


# ------------------------------------------------------------ ARC to WARC

def test_archives_round_trip(spark):
    import hashlib
    big = "é\r\n\r\nWARC/1.0\r\n" + "x" * 2000
    rows = [(1, "http://a/ b", big), (2, None, big), (3, "http://c", "small"), (4, "http://c", "small"), (5, "u", None),
            (None, "u", big), (7, "u", ""), (8, "http://d\nx", "y" * 1000)]
    df = spark.createDataFrame([r + ("clash",) for r in rows], "page_id long, url string, html string, key string").repartition(3)
    rules = arc_warc.ArcRules()
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    arc_warc.write_arc(df, arc, rules)
    arc_warc.convert(spark, arc, warc, rules)
    got = {r.key: r for r in arc_warc.read_warc(spark, warc).collect()}
    assert len(got) == len(rows)
    for k, _, html in rows:
        r, raw = got[None if k is None else str(k)], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert [got[k].record_type for k in ("1", "2", "3", "4", "8")] == ["revisit", "response", "response", "response", "response"]
    assert got["1"].refers_to == got[None].refers_to == "2" and got["2"].refers_to is None


def test_archive_types_addresses_and_references(spark, tmp_path):
    import gzip
    import hashlib
    http = "HTTP/1.1 200 OK\r\nX-Archive-Key: {}\r\n\r\n"
    big = "z" * 1500
    docs = [("dns:a.example", "text/dns", "8.8.8.8", big), ("http://a.example/", "text/html", "10.0.0.1", http.format(1) + big),
            ("http://b.example/", "text/html", "0.0.0.0", http.format(2) + big), ("ftp://c.example/f", "no-type", "::1", "plain"),
            ("dns:b.example", "text/dns", "none", big)]
    info = "1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    text = f"filedesc://x 0.0.0.0 20200101000000 text/plain {len(info)}\n{info}\n" + "".join(
        f"{u} {ip} 20200102030405 {mime} {len(b)}\n{b}\n" for u, mime, ip, b in docs)
    arc, warc = tmp_path / "arc", str(tmp_path / "warc")
    arc.mkdir()
    (arc / "part-0.arc.gz").write_bytes(gzip.compress(text.encode()))
    arc_warc.convert(spark, str(arc), warc, arc_warc.ArcRules())
    records = [(f, b) for p in (tmp_path / "warc").glob("part-*")
               for f, b in arc_warc.warc_records(gzip.decompress(p.read_bytes()))]
    assert [f["WARC-Type"] for f, _ in records] == ["warcinfo", "resource", "revisit", "response", "resource", "resource"]
    by = {f["WARC-Target-URI"]: f for f, _ in records[1:]}
    assert [by[u].get("WARC-IP-Address") for u, *_ in docs] == ["8.8.8.8", "10.0.0.1", None, "::1", None]
    assert by["dns:a.example"]["Content-Type"] == "text/dns"
    assert by["ftp://c.example/f"]["Content-Type"] == "application/octet-stream"
    first, keeper = by["http://a.example/"], by["http://b.example/"]
    assert first["WARC-Refers-To"] == keeper["WARC-Record-ID"]
    assert first["WARC-Refers-To-Target-URI"] == "http://b.example/" and first["WARC-Refers-To-Date"] == "2020-01-02T03:04:05Z"
    read = {r.target: r for r in arc_warc.read_warc(spark, warc).collect()}
    assert len(read) == 5 and read["dns:b.example"].payload_digest == hashlib.sha1(big.encode()).hexdigest()


def test_arc_versions_and_errors():
    for v in "12":
        head = arc_warc.arc_header(v, url="filedesc://x", ip="0.0.0.0", date="20200101000000", mime="text/plain", status=200,
                                   checksum="-", location="-", offset=0, file="x", length=6).encode() + b"\n" + v.encode() + b" 0 o\n\n"
        doc = arc_warc.arc_header(v, url="http://a", ip="1.2.3.4", date="20010203040506", mime="text/html", status=200,
                                  checksum="-", location="-", offset=9, file="x", length=5).encode() + b"\nab\ncd\n"
        (f, block), = arc_warc.arc_records(head + doc)
        assert (f["url"], f["date"], block) == ("http://a", "20010203040506", b"ab\ncd")
        with pytest.raises(ValueError):
            list(arc_warc.arc_records((head + doc)[:-3]))
    with pytest.raises(ValueError):
        list(arc_warc.arc_records(b"http://a 1 2 3 4\nabcd\n"))


# -------------------------------------------------------------- fertility

def test_base_counts_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice(["ab", "c", "é", " ", "  ", "\n", "\t", "#", "a b c ", "漢"]) for _ in range(rng.randrange(0, 300))))
            for k in range(60)] + ODD
    got = fertility.quality_columns(docs(spark, rows), registry.fertility_rules()).collect()
    want = []
    for i, t in rows:
        t = t or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for x in t.split("\n"):
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
        windows = {}
        for k in range(len(w) - 2):
            windows.setdefault(tuple(w[k:k + 3]), []).append(k)
        rep = len({k + d for ks in windows.values() if len(ks) > 1 for k in ks for d in range(3)})
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, rep,
                     len(w) < 50 or 100 * rep > 50 * len(w)))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(want, key=key)
    assert not any(r.kept and r.base_failed for r in got)


def test_fertility_bands(spark):
    import public_tokenizers  # noqa: F401
    prose = "The committee met on Tuesday to discuss the annual report and agreed that further work would be needed before spring. " * 3
    varied = " ".join(f"{w}{k}" for k, w in enumerate(prose.split()))
    symbols = " ".join(w + "%%%" for w in prose.split()[:30]) + " " + " ".join(f"x{k}$$$" for k in range(60))
    kept = fertility.keep(docs(spark, [(1, "A report of the spring meeting. " + prose[:118] + varied[:600]), (2, symbols), (3, None)]),
                          registry.fertility_rules())
    assert 2 not in {r.doc_id for r in kept.collect()} and kept.columns[0] == "doc_id"


# ---------------------------------------------------- nearest neighbours

def test_neighbours_recall_ties_and_odd_vectors(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(12, 16)) * 2
    x = (centre[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16))).astype(np.float32)
    x[200:260] = x[200]                                     # a hot vector
    rows = [(int(k), [float(c) for c in v], "e") for k, v in enumerate(x)]
    rows += [(2000, None, "e"), (2100, [0.0] * 16, "e"), (2200, [float("nan")] * 16, "e"), (2300, [1.0], "e"), (None, rows[0][1], "e"),
             (300, rows[300][1], "e")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, part string")
    got = {}
    for r in learned_ann.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        want = sorted((d[k], k) for k in range(len(x)) if k != q)[:10]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert all(f[2] == pytest.approx(d[f[1]], abs=1e-12) for f in found)
        assert [(f[2], f[1]) for f in found] == sorted((f[2], f[1]) for f in found)
        hits += len({f[1] for f in found} & {w[1] for w in want})
    assert hits >= 0.9 * 10 * len(got)
    assert [f[1] for f in got[200]] == list(range(201, 211))
    assert learned_ann.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# -------------------------------------------------------------------- BPE

def test_automaton_equals_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(7)
    texts = ["aaaa aaaaa aaa a " + "a" * 40, "<|endoftext|>x <|startoftext|>Y", "ΣΑΣ İstanbul ǅ ﬁ ① ½ ５ z\x85q 漢字 हिन्दी",
             "'s don't we'll I'M '’re", "x" * 3000 + "é" * 500, "!!!???...\n\t''''s't'rex", "a\x1cb\u200bc"]
    texts += ["".join(rng.choice("abthe' 1é.") for _ in range(rng.randrange(0, 60))) for _ in range(200)]
    rows = list(enumerate(texts)) + ODD
    got = bpe_automaton.encode_documents(docs(spark, rows), registry.vocabulary("word_bpe_49k.json")).collect()
    for (i, text), r in zip(sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]),
                            sorted((r for r in got if r.doc_id is not None), key=lambda r: r.doc_id)):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), t.decode(ids, skip_special_tokens=False)), text


def test_gadgets_accept_exactly_correct_tokenizations():
    merges = [("a", "a"), ("b", "a"), ("aa", "b"), ("ba", "ba"), ("a", "b"), ("aa", "aa")]
    vocab = {s: k for k, s in enumerate(["a", "b", *("".join(m) for m in merges)])}
    m = bpe_automaton.Automaton(vocab, merges)
    rank = {p: k for k, p in enumerate(merges)}
    for n in range(1, 9):
        for word in map("".join, itertools.product("ab", repeat=n)):
            parts = list(word)
            while pairs := [(rank[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in rank]:
                k = min(pairs)[1]
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
            assert m.labels(m.encode(word)) == parts, word


# --------------------------------------------------------------- licenses

def test_license_suppression_equals_brute_force():
    import random
    import time
    rnd = random.Random(3)
    for _ in range(200):
        found = []
        for k in range(rnd.randrange(40)):
            start = rnd.randrange(30)
            found.append((start, start + rnd.randrange(1, 12), rnd.randrange(4), k, "l", 1.0))
        kept = []
        for d in sorted(found, key=lambda d: (-d[2], d[0] - d[1], d[0], d[3])):
            if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
                kept.append(d)
        assert licenses.resolve(found) == sorted(kept)
    many = [(5 * k, 5 * k + 7, k % 5, k, "l", 1.0) for k in range(100_000)]
    start = time.monotonic()
    assert len(licenses.resolve(many)) == 100_000 and time.monotonic() - start < 20


def test_license_base_places_equal_brute_force(spark):
    rng = random.Random(9)
    pool = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "by", "nc", "x", "é"]
    rows = [(k, "".join(rng.choice(pool) + rng.choice([" ", "-", ", ", "\n"]) for _ in range(rng.randrange(0, 80)))) for k in range(150)]
    rows += [(500, "Under the MIT license; under the  mit-license. CC-BY-NC apache license version 2"), (501, "éunder the mit license")] + ODD
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = licenses.scan_licenses(docs(spark, rows)).collect()
    want = []
    for i, t in rows:
        w = word.findall(lower(t))
        at = sorted((k, label) for p, label in licenses.BASE for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        want.append((i, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(want, key=key)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)


def test_containment_and_priority():
    assert len(licenses.signature_rules()) > 300
    keep = licenses.resolve([(0, 10, 3, 0, "a", 1.0), (2, 8, 5, 1, "b", 1.0), (2, 8, 5, 2, "c", 1.0), (1, 5, 3, 3, "d", 1.0)])
    assert [d[4] for d in keep] == ["a", "b"]
    s = licenses.Scanner(licenses.signature_rules())
    assert s.scan(b"released under the gnu general public license v3", 0)[4] == "gpl-3"
    assert "cc-by-sa-4.0" in s.scan(b"available under cc by-sa 4.0", 0)[4].split(",")


# ------------------------------------------------------------ language ID

def test_language_identification(spark):
    rng = random.Random(11)
    bank = {"aa": ["lorem", "ipsum", "dolor"], "bb": ["xkcd", "zzyx", "qwrt"], "cc": ["ñoño", "çaça", "über"]}
    rows = [(k, " ".join(rng.choice(bank[lang]) for _ in range(60)), lang) for k, lang in enumerate(rng.choices(sorted(bank), k=240))]
    odd = [(900, None, "aa"), (901, "123 .,;", "aa"), (902, "", "bb"), (903, "zzyx xkcd", None)]
    df = spark.createDataFrame([r + (1.0,) for r in rows + odd], "doc_id long, text string, lang string, score double")
    model = langid.fit(df, langid.Training(docs_per_lang=60, epochs=6))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, model).collect()}
    import zlib
    held = [(k, lang) for k, _, lang in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum(got[k][0] == lang for k, lang in held) >= 0.95 * len(held) > 20
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "bb"
    assert not {900, 901, 902} & {r.doc_id for r in langid.keep(df, model, 0.3).collect()}
    nothing = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}


# ------------------------------------------------------------- line dedup

@pytest.mark.parametrize("tau", [1, 2])
def test_line_dedup_equals_brute_force(spark, tau):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(18, 40))) for _ in range(40)]

    def changed(s):
        s = list(s)
        for _ in range(rng.randrange(0, 4)):
            k, p = rng.randrange(3), rng.randrange(len(s))
            s[p:p + (k != 1)] = [] if k == 2 else [rng.choice("abcdé")]
        return "".join(s)
    rows = [(k, "\n".join(changed(rng.choice(base)) for _ in range(rng.randrange(1, 6)))) for k in range(50)]
    rows += [r for r in ODD if r[0] is not None]
    rules = line_dedup.LineRules(tau, 20)
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, rows), rules).collect()}
    places = sorted({(i, n, x) for i, t in rows if t for n, x in enumerate(t.split("\n")) if len(x) >= 20 and x.strip()})
    first = {}
    for i, n, x in places:
        first.setdefault(x, (i, n))
    near = {x for x in first if any(first[y] < first[x] and edits(x, y) <= tau for y in first if y != x)}
    for i, t in rows:
        want = None if t is None else "\n".join(
            x for n, x in enumerate(t.split("\n")) if x not in near and first.get(x, (i, n)) == (i, n))
        assert got[i].text == want, i
    assert line_dedup.line_dedup(docs(spark, rows).limit(0), rules).count() == 0


def test_line_dedup_removes_short_repeats(spark):
    rows = [(1, "Les.\nHaanth.\n \nLes."), (2, "Haanth."), (3, "\nonly here\nLes.\nLet."), (4, "x\nx\nx"), (5, "Haanth.\n \nLes.")]
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs(spark, rows), line_dedup.LineRules()).collect()}
    assert {i: (r.text, r.n_lines, r.n_exact, r.n_near) for i, r in got.items()} == {
        1: ("Les.\nHaanth.\n ", 3, 1, 0), 2: ("", 1, 1, 0), 3: ("\nonly here\nLet.", 3, 1, 0), 4: ("x", 3, 2, 0), 5: (" ", 2, 2, 0)}
    left = line_dedup.apply(docs(spark, rows), line_dedup.LineRules(), length_col=None)
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]


def test_line_dedup_tells_texts_of_one_id_apart(spark):
    same, other = "a line that several documents hold", "another line that several hold"
    rows = [(None, f"unlike any of the others, one\n{same}"), (None, f"not to be found elsewhere, two\n{same}"),
            (None, "three is alone with its line\nand with its second line, too"), (7, f"{other}\nof its own: zero one"),
            (7, f"stands here and nowhere else\n{other}"), (8, f"{same}\n{other}\nleft of eight"), (None, None),
            (9, "twice the very same row"), (9, "twice the very same row")]
    got = line_dedup.line_dedup(docs(spark, rows), line_dedup.LineRules()).collect()
    texts = [r.text for r in got]
    lines = [x for t in texts for x in (t or "").split("\n") if x]
    assert len(got) == len(rows) and texts.count(None) == 1 and texts.count("twice the very same row") == 2
    want = {x for _, t in rows for x in (t or "").split("\n") if x}
    assert set(lines) == want and len(lines) == len(want) + 1
    assert sum(same in (r.text or "") for r in got if r.doc_id is None) == 1
    assert sum(other in r.text for r in got if r.doc_id == 7) == 1
    assert [r.text for r in got if r.doc_id == 8] == ["left of eight"]
    again = line_dedup.apply(docs(spark, rows), line_dedup.LineRules(), length_col=None).collect()
    assert sorted(r.text or "" for r in again) == sorted(t or "" for t in texts)


def test_line_dedup_finds_replaced_words(spark):
    """Words replaced, lost and put in, up to and beyond the threshold."""
    rng, per = random.Random(4), 4
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 9)))
    base = [[word() for _ in range(n)] for n in (3, 5, 7, 8, 11, 19, 24, 31, 40, 90, 129, 140, 256)]
    rows = []
    for k in range(90):
        w = list(base[k % len(base)])
        for _ in range(rng.randrange(0, len(w) // per + 2)):
            kind, p = rng.randrange(4), rng.randrange(len(w))
            w[p:p + (kind != 1)] = [] if kind == 2 else [word()]
        rows.append((k, " ".join(w)))
    rows += [(200, "這是一個很長的句子沒有空格但是有很多字"), (201, "這是一個很長的句子沒有空間但是有很多字")]
    rules = line_dedup.LineRules(2, 20, words_per_edit=per)

    def tokens(t):
        return list(t) if "這" in t else t.split(" ")

    def limit(n):
        return n // per

    def near(s, t):
        a, b = tokens(s), tokens(t)
        return edits(a, b) <= limit(min(len(a), len(b))) or min(len(s), len(t)) >= 20 and abs(len(s) - len(t)) <= 2 and edits(s, t) <= 2
    want = {i: not any(j < i and near(t, u) for j, u in rows) for i, t in rows}
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(docs(spark, rows), rules).collect()}
    assert {i: got[i] != "" for i, _ in rows} == want and 15 < sum(want.values()) < 75
    # one word of thirty, more than two characters, with the rules of production
    line = "a line of thirty words " + " ".join(f"word{k}" for k in range(24))
    two = [(1, line), (2, line.replace("word7", "another")), (3, line.replace("word7", "several").replace("word9 ", "different "))]
    assert [r.doc_id for r in line_dedup.apply(docs(spark, two), line_dedup.LineRules(), length_col=None).collect()] == [1, 3]


@pytest.mark.parametrize("crowd", [128, 1 << 20])
def test_met_rows_are_those_of_shared_and_of_crowded_keys(spark, crowd, monkeypatch):
    monkeypatch.setattr(line_dedup, "_CROWD", crowd)
    rows = [(h, 7, h % 2 == 0) for h in range(640)] + [(h, 100 + h // 2, False) for h in range(50)] + [(3, 900, True)] * 3
    rows += [(5, 100 + 5 // 2, True), (5, 2 ** 63 - 1, True)]
    df = spark.createDataFrame(rows, "h long, key long, own boolean")
    got = {tuple(r) for r in line_dedup.met_rows(df, Scratch(spark, "t"), "met").select("key", "h", "own").collect()}
    held = {}
    for h, key, own in rows:
        held.setdefault(key, {}).setdefault(h, []).append(own)
    assert got == {(key, h, max(own)) for key, by in held.items() if len(by) > 1 for h, own in by.items()}


def test_words_as_characters_and_letters(spark):
    codes = [0, 1, 0xFFFF, 0xFFFFF, 70_000]
    words = [3, -5, 26, 26, 3]
    r = spark.range(1).select(
        line_dedup._text(F.array(*[F.lit(c).cast("long") for c in codes])).alias("text"),
        line_dedup._word_bag(F.array(*[F.lit(w).cast("long") for w in words])).alias("bag"))
    r = r.select("*", F.array(line_dedup._letters(0, "bag"), line_dedup._letters(1, "bag")).alias("sig")).first()
    assert r.text == "".join(chr(0x10000 + c) for c in codes)
    assert r.bag == "dvaad" and r.sig == [2 + (2 << 12), 1 << 32]


@pytest.mark.parametrize("crowd", [128, 1 << 20])
def test_met_rows_of_the_index_leave_out_keys_of_probes_alone(spark, crowd, monkeypatch):
    monkeypatch.setattr(line_dedup, "_CROWD", crowd)
    hs = [-2 ** 63 + k * (2 ** 64 // 640) for k in range(640)]
    rows = [(h, 7, h == hs[9]) for h in hs] + [(h, 100 + k // 2, k % 4 == 0) for k, h in enumerate(hs[:50])]
    rows += [(hs[300], 900, True)] * 3 + [(hs[500], 901, True), (hs[500], 901, False)] + [(h, 902, False) for h in hs[20:60]]
    df = spark.createDataFrame(rows, "h long, key long, own boolean")
    got = {tuple(r) for r in line_dedup.met_rows(df, Scratch(spark, "t"), "met", indexed=True).select("key", "h", "own").collect()}
    held = {}
    for h, key, own in rows:
        held.setdefault(key, {}).setdefault(h, []).append(own)
    crowded = {key for key, by in held.items() if sum(h < -2 ** 63 + 2 ** 58 for h in by) >= crowd // 64}    # these all stay
    assert got == {(key, h, max(own)) for key, by in held.items() if len(by) > 1 and (key in crowded or any(map(any, by.values())))
                   for h, own in by.items()}
    assert (7 in crowded) == (crowd == 128) and 902 not in {key for key, _, _ in got}


def test_counts_of_letters_are_compared_at_once_in_code_that_is_compiled(spark):
    rng = random.Random(8)
    pairs = []
    for k in range(600):
        a = [rng.randrange(1 << 52) for _ in range(2)]
        b = [x ^ rng.choice([0, 1, 8, 15]) << rng.randrange(49) if k % 2 else rng.randrange(1 << 52) for x in a]
        pairs.append((k, [0, 0] if k < 3 else a, [(1 << 52) - 1] * 2 if k == 1 else b))
    df = spark.createDataFrame([(k, *a, *b) for k, a, b in pairs], "k int, sig0_a long, sig1_a long, sig0_b long, sig1_b long")

    def apart(a, b):
        return sum(abs(((x >> 4 * k & 15) - (y >> 4 * k & 15) + 8) % 16 - 8) for x, y in zip(a, b) for k in range(13))
    near = df.select("k", *[line_dedup._bags_near(F.lit(m)).alias(f"m{m}") for m in (0, 2, 20, 40, 52)])
    for (k, a, b), r in zip(pairs, near.orderBy("k").collect()):
        assert tuple(r)[1:] == tuple(apart(a, b) <= 2 * m for m in (0, 2, 20, 40, 52)), k
    plan = df.filter(line_dedup._bags_near(F.lit(2)))._jdf.queryExecution()
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", spark._jvm.PythonSQLUtils.explainString(plan, "codegen"))
    assert sizes and max(map(int, sizes)) < 8000      # the JVM interprets longer methods for ever


def test_line_dedup_keeps_columns_and_drops_emptied_documents(spark):
    line = "a line that is long enough to count"
    df = spark.createDataFrame([(1, line, "a", 35, 9), (2, line + ".", "b", 36, 9), (3, "other text\n" + line, "c", 46, 9), (4, None, "d", 0, 9),
                                (5, "", "e", 0, 9)], "doc_id long, text string, source string, n_chars long, gone long")
    got = {r.doc_id: r for r in line_dedup.apply(df, line_dedup.LineRules()).collect()}
    assert sorted(got) == [1, 3, 4, 5]
    assert (got[3].text, got[3].n_chars, got[3].gone) == ("other text", 10, 9) and got[1].text == line


# --------------------------------------------------------------- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    d = "/root/testdata/sf0.001"
    docs0 = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["language ID", "quality rules", "line dedup", "n-gram Jaccard join", "best-fit packing"]
    out = P.run(spark, d)
    assert 0 < out.select("doc_id").distinct().count() <= docs0.count()
    got = out.groupBy("doc_id").agg(F.sum("n_places").alias("p"), F.first("n_words").alias("w")).filter("w > 0 AND p <> w + 1")
    assert got.count() == 0


def test_registered_queries():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{k}" for k in range(1, 14)]


# ------------------------------------------------ null ids in the Jaccard join

def test_links_through_documents_without_ids(spark):
    words = [f"w{k}" for k in range(74)]
    near = words[:42] + ["other"] + words[43:]                  # 65 of 75 shingles
    far = near[:20] + ["third"] + near[21:]                     # near to the second, not to the first
    def jac(a, b):
        x, y = ({tuple(t[k:k + 5]) for k in range(len(t) - 4)} for t in (a, b))
        return len(x & y) / len(x | y)
    assert min(jac(words, near), jac(near, far)) >= 0.8 > jac(words, far)
    middle = (None, " ".join(near))
    rows = [(1, " ".join(words)), middle, middle, (3, " ".join(far)), (None, "alone without an id and unlike the rest"), (None, ""), (4, " \t")]
    got = jaccard_join.jaccard_components(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles > 5, r.component_id) for r in got if r.n_shingles > 5) == [
        ("1", True, 1), ("3", True, 1), ("None", True, 1), ("None", True, 1)]
    kept = jaccard_join.one_of_each(docs(spark, rows + [(7, " ".join(far)), (None, rows[4][1])]))
    assert sorted((str(r.doc_id), len(r.text.split())) for r in kept.collect()) == [("1", 74), ("4", 0), ("None", 0), ("None", 8)]


# ------------------------------------------------- memory of Python workers

def test_quality_rules_keep_a_worker_small():
    """Texts of many different words: cache and parts stay within some MB."""
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(9))
    texts = [" ".join(word() for _ in range(200)) for _ in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    rules = registry.fertility_rules()
    rest = fertility.FertilityRules(b"")
    tracemalloc.start()
    parts = [(part.num_rows, out["n_words"].tolist()) for part, out in
             fertility._measured([batch], "text", rest, rules.vocabulary)]
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert sum(n for n, _ in parts) == len(texts) and {w for _, ws in parts for w in ws} == {200}
    assert peak < 90, peak


def test_written_steps_get_small_batches(spark):
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    rows = spark.range(0, 12000, 1, 1).selectExpr("id", "repeat('abcdefgh', 256) AS text")
    got = Scratch(spark, "batches").put(rows.mapInArrow(sizes, "n long, bytes long"), "sizes").collect()
    assert sum(r.n for r in got) == 12000 and max(r.bytes for r in got) < 9e6
    assert spark.conf.get(key, None) == before
