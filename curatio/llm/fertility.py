"""Quality rules by tokeniser fertility.

The words of a text (runs of ``[^\\x20\\x09-\\x0D]``) are segmented with a
public SentencePiece vocabulary. Per text: characters per token, tokens per
word, share of byte-fallback tokens, and entropy of the token distribution,
which grows with the length of a text and so is taken relative to the bits of
as many equally frequent tokens (256 at most). Each measure is held against a
band of the text's main script. Pure per-row work: one
``mapInArrow`` without shuffles; memory is bounded by the text chunk and a
bounded word cache.

Defined results: null or empty text has no words and fails the base rule
(``n_words < min_words``); nulls in other columns are carried; repeated rows
and ties give equal results; an empty table gives no rows; extra columns are
ignored by :func:`quality_columns` and kept as they are by :func:`keep`, also
when their names clash, as rows are only filtered there."""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curatio.llm import textnum as tn
from curatio.operators.util import ship_by_value

#: Code point ranges of scripts (fixed values); a text's script is the one
#: with most characters, "other" where none has any.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "indic": ((0x900, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
    "hangul": ((0xAC00, 0xD7A3), (0x1100, 0x11FF)),
}


@dataclass(frozen=True)
class Band:
    """Accepted range of a script."""
    chars_per_token: tuple[float, float]
    max_tokens_per_word: float
    max_byte_share: float
    min_entropy: float                     # relative, 0 to 1


@dataclass(frozen=True)
class FertilityRules:
    vocabulary: bytes                      # a SentencePiece model file
    min_words: int = 50
    max_repeat_percent: int = 50
    symbols: str = "#*$%&|<>"
    bands: dict = field(default_factory=lambda: dict(BANDS))


#: Bands by script (fixed values): non-Latin scripts have fewer characters
#: per token and more byte fallback in a vocabulary made mainly of Latin
#: text; scripts written without spaces have no bound on tokens per word.
BANDS = {
    "latin": Band((1.55, 8.0), 3.3, 0.05, 0.72),
    "greek": Band((0.8, 6.0), 12.0, 0.30, 0.55),
    "cyrillic": Band((1.0, 8.0), 8.0, 0.30, 0.55),
    "hebrew": Band((0.5, 6.0), 12.0, 0.60, 0.45),
    "arabic": Band((0.5, 6.0), 12.0, 0.60, 0.45),
    "indic": Band((0.2, 6.0), 40.0, 0.95, 0.40),
    "thai": Band((0.2, 6.0), 1e9, 0.95, 0.40),
    "kana": Band((0.3, 6.0), 1e9, 0.80, 0.45),
    "han": Band((0.3, 6.0), 1e9, 0.80, 0.45),
    "hangul": Band((0.25, 6.0), 40.0, 0.90, 0.45),
    "other": Band((0.2, 8.0), 1e9, 0.95, 0.30),
}

#: Words that one worker process keeps segmented, and bytes of text that it
#: measures at a time; both bound its memory.
CACHE_WORDS, CHUNK_BYTES = 200_000, 1 << 18

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, script string, n_tokens long, "
           "chars_per_token double, tokens_per_word double, byte_share double, token_entropy double, "
           "relative_entropy double")


class _Segmenter:
    """Words to token ids with a bounded cache; all words of a chunk at once.
    The cache holds packed ids, which take a third of the memory of lists."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.sp.get_piece_size()
        self.is_byte = np.fromiter((self.sp.is_byte(i) for i in range(n)), bool, n)
        self.size = n
        self.cache: dict[int, bytes] = {}

    def ragged(self, buf, start, end, hashes):
        """For each distinct hash: (token ids joined, their counts)."""
        keys = hashes.tolist()
        got = [self.cache.get(k) for k in keys]
        missing = [i for i, g in enumerate(got) if g is None]
        if missing:
            raw = buf.tobytes()
            found = self.sp.encode([raw[start[i]:end[i]].decode("utf-8", "replace") for i in missing],
                                   num_threads=1)
            if len(self.cache) + len(missing) > CACHE_WORDS:
                self.cache.clear()
            room = CACHE_WORDS - len(self.cache)
            for i, ids in zip(missing, found):
                got[i] = array("i", ids).tobytes()
                if room > 0 and len(ids) <= 64:
                    self.cache[keys[i]] = got[i]
                    room -= 1
        counts = np.fromiter(map(len, got), np.int64, len(got)) // array("i").itemsize
        return np.frombuffer(b"".join(got), np.intc).astype(np.int64), counts


def _script(buf, offsets, n):
    """Main script of each row, by counts of code points."""
    names = list(SCRIPTS)
    counts = np.zeros((len(names), n), np.int64)
    lead = (buf & 0xC0) != 0x80
    pos = np.flatnonzero(lead & (buf >= 0xC3))
    row_of = lambda p: np.searchsorted(offsets[1:], p, "right")
    ascii_letter = np.flatnonzero(((buf | 32) >= 97) & ((buf | 32) <= 122) & (buf < 128))
    latin = names.index("latin")
    counts[latin] += np.diff(np.searchsorted(ascii_letter, offsets))
    if len(pos):
        b = [buf[np.minimum(pos + k, len(buf) - 1)].astype(np.int64) for k in range(4)]
        cp = np.where(b[0] < 0xE0, (b[0] & 31) << 6 | b[1] & 63,
                      np.where(b[0] < 0xF0, (b[0] & 15) << 12 | (b[1] & 63) << 6 | b[2] & 63, 0x110000))
        rows = row_of(pos)
        for k, name in enumerate(names):
            hit = np.zeros(len(cp), bool)
            for lo, hi in SCRIPTS[name]:
                if lo > 0x7F:
                    hit |= (cp >= lo) & (cp <= hi)
            if hit.any():
                counts[k] += np.bincount(rows[hit], minlength=n)
    best = counts.argmax(axis=0)
    return [names[k] if counts[k, i] else "other" for i, k in enumerate(best)]


def measure(col: pa.Array, rules: FertilityRules, hasher: tn.Hasher, seg: _Segmenter) -> dict:
    """All measures of a chunk of texts."""
    buf, offsets = tn.as_bytes(col)
    n = len(offsets) - 1
    start, end, row = tn.runs(buf, offsets, tn.NOT_SPACE)
    words = hasher.ranges(buf, start, end)
    per_row = lambda r, w=None: np.bincount(r, weights=w, minlength=n).astype(np.int64)
    n_words = per_row(row)
    # code points in words: bytes of words that don't continue a character
    lead = np.concatenate([[0], np.cumsum(((buf & 0xC0) != 0x80) & tn.NOT_SPACE[buf])])
    word_chars = lead[offsets[1:]] - lead[offsets[:-1]]
    symbol = tn.byte_class(*[(ord(c), ord(c)) for c in rules.symbols])
    sym = np.concatenate([[0], np.cumsum(symbol[buf])])
    n_symbols = sym[offsets[1:]] - sym[offsets[:-1]]
    # lines that have a word and equal an earlier line of their text
    ls, le, lr = tn.lines(buf, offsets)
    worded = np.searchsorted(start, le, "left") > np.searchsorted(start, ls, "left")
    ls, le, lr = ls[worded], le[worded], lr[worded]
    lh = hasher.ranges(buf, ls, le)
    pair = np.lexsort((lh, lr))
    same = (lr[pair][1:] == lr[pair][:-1]) & (lh[pair][1:] == lh[pair][:-1])
    n_dup = per_row(lr[pair][1:][same])
    # words inside 3-word windows that occur twice or more in their text
    wh, first = tn.windows(words, row, 3)
    order = np.lexsort((wh, row[first]))
    r, h = row[first][order], wh[order]
    eq = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= eq
    twice[:-1] |= eq
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[first[order[twice]] + k] = True
    n_repeat = per_row(row[hit])
    # tokens
    uniq, at, back = np.unique(words, return_index=True, return_inverse=True)
    ids, counts = seg.ragged(buf, start[at], end[at], uniq)
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    many = counts[back]
    total = int(many.sum())
    flat = np.repeat(begin[back] - np.concatenate([[0], np.cumsum(many)])[:-1], many) + np.arange(total)
    tokens, trow = ids[flat], np.repeat(row, many)
    n_tokens = per_row(trow)
    key, count = np.unique(trow * seg.size + tokens, return_counts=True)
    krow = key // seg.size
    with np.errstate(divide="ignore", invalid="ignore"):
        p = count / n_tokens[krow]
        entropy = np.bincount(krow, weights=-p * np.log2(p), minlength=n) + 0.0
        byte_share = np.bincount(trow, weights=seg.is_byte[tokens], minlength=n) / np.maximum(n_tokens, 1)
        cpt = word_chars / np.maximum(n_tokens, 1)
        tpw = n_tokens / np.maximum(n_words, 1)
        relative = entropy / np.log2(np.clip(n_tokens, 2, 256))
    script = _script(buf, offsets, n)
    failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    kept = np.zeros(n, bool)
    for i in np.flatnonzero(~failed):
        b = rules.bands.get(script[i], rules.bands["other"])
        kept[i] = (b.chars_per_token[0] <= cpt[i] <= b.chars_per_token[1]
                   and tpw[i] <= b.max_tokens_per_word and byte_share[i] <= b.max_byte_share
                   and relative[i] >= b.min_entropy)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup,
            "n_repeat_words": n_repeat, "base_failed": failed, "kept": kept, "script": script,
            "n_tokens": n_tokens, "chars_per_token": cpt, "tokens_per_word": tpw, "byte_share": byte_share, "token_entropy": entropy,
            "relative_entropy": relative}


def _measured(batches, text_col: str, rules: FertilityRules, vocabulary: bytes):
    """(part, its measures) of the batches, in parts of bounded size."""
    hasher, seg = tn.Hasher(), _Segmenter(vocabulary)
    for batch in batches:
        for part in tn.chunks(batch, text_col, CHUNK_BYTES):
            yield part, measure(part.column(text_col), rules, hasher, seg)


def _arrow(out: dict) -> list[pa.Array]:
    return [pa.array(v) if isinstance(v, list) else pa.array(np.ascontiguousarray(v)) for v in out.values()]


def _shipped() -> None:
    ship_by_value(__name__, "curatio.llm.textnum")


def quality_columns(docs: DataFrame, rules: FertilityRules, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: its id, the base counts, the fertility measures
    and the verdict."""
    _shipped()
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    cached = docs.sparkSession.sparkContext.broadcast({"rules": rules.vocabulary})
    rest = FertilityRules(b"", rules.min_words, rules.max_repeat_percent, rules.symbols, rules.bands)
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        for part, out in _measured(batches, "text", rest, cached.value["rules"]):
            yield pa.RecordBatch.from_arrays([part.column("id"), *_arrow(out)], [id_col, *out])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, {COLUMNS}")


def keep(docs: DataFrame, rules: FertilityRules, text_col: str = "text") -> DataFrame:
    """The input rows, whole and unchanged, whose verdict is ``kept``."""
    _shipped()
    cached = docs.sparkSession.sparkContext.broadcast({"rules": rules.vocabulary})
    rest = FertilityRules(b"", rules.min_words, rules.max_repeat_percent, rules.symbols, rules.bands)

    def run(batches):
        for part, out in _measured(batches, text_col, rest, cached.value["rules"]):
            yield part.filter(pa.array(out["kept"]))

    return docs.mapInArrow(run, docs.schema)
