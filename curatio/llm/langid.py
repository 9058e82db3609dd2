"""Language identification by a byte convolutional network.

The network embeds bytes, applies filters of widths 2, 3 and 4, keeps each
filter's maximum over a fixed-length window and classifies with a softmax. It
is trained in numpy on labelled text: a bounded, documented sample of windows
(``docs_per_lang`` documents per language, those with the smallest hash of
their id, ``windows_per_doc`` windows each). Prediction covers every byte of
every text: consecutive windows in batches, probabilities averaged by the
bytes that each window holds.

Prediction is one ``mapInArrow`` without shuffles; the model is a few
kilobytes. Defined results: null text, or text without a letter, is ``und``
with score 0, as is every text when there is nothing to learn from; rows with
a null language are never learned from; ties go to the language that sorts
first; repeated rows get equal results; an empty table gives no rows; extra
columns are ignored by :func:`predict` and kept by :func:`keep`."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.llm import textnum as tn
from curatio.operators.curate import cap_per_group
from curatio.operators.util import measured_broadcast, ship_by_value

WINDOW = 256
WIDTHS = (2, 3, 4)
UNDETERMINED = "und"


@dataclass(frozen=True)
class Training:
    docs_per_lang: int = 500
    windows_per_doc: int = 6
    embedding: int = 8
    filters: int = 12          # per width
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4))


def training_windows(docs: DataFrame, cfg: Training, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """(lang, bytes) windows of the documents with the smallest id hashes of
    each language; the fold with remainder 2 is left out."""
    ship_by_value(__name__, "curatio.llm.textnum")
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    src = src.filter("lang IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL").filter(fold(F.col("id")) != 2)
    # ids first: a histogram of their hashes cuts each language, so no language
    # meets in one task; then their texts
    chosen = cap_per_group(src.select("lang", "id"), "lang", "id", cfg.docs_per_lang, cfg.seed).select("id").distinct()
    chosen = src.join(measured_broadcast(chosen), "id")

    def cut(batches):
        for batch in batches:
            langs, out = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode("utf-8")
                starts = range(0, max(1, len(raw)), WINDOW)
                step = max(1, len(starts) // cfg.windows_per_doc)
                for s in list(starts)[::step][:cfg.windows_per_doc]:
                    if len(raw[s:s + WINDOW].strip()) >= 16:
                        langs.append(lang)
                        out.append(raw[s:s + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["lang", "raw"])

    return chosen.select(F.col("lang").cast("string"), "text").mapInArrow(cut, "lang string, raw binary")


def _matrix(raws: list[bytes]) -> np.ndarray:
    joined = b"".join(r[:WINDOW].ljust(WINDOW, b"\0") for r in raws)
    return tn.lower_ascii(np.frombuffer(joined, np.uint8)).reshape(-1, WINDOW)


def _mask(cfg_filters: int, dim: int) -> np.ndarray:
    """Which weights a filter has: those of its first ``width`` bytes."""
    m = np.zeros((max(WIDTHS), dim, len(WIDTHS) * cfg_filters), np.float32)
    for k, w in enumerate(WIDTHS):
        m[:w, :, k * cfg_filters:(k + 1) * cfg_filters] = 1
    return m.reshape(max(WIDTHS) * dim, -1)


def _columns(x: np.ndarray, emb: np.ndarray) -> np.ndarray:
    """Embedded bytes of each position and the next ones: (n, WINDOW, 4*dim)."""
    n, dim = len(x), emb.shape[1]
    e = np.zeros((n, WINDOW + max(WIDTHS) - 1, dim), np.float32)
    e[:, :WINDOW] = emb[x]
    e = e.reshape(n, -1)
    view = np.lib.stride_tricks.as_strided(
        e, (n, WINDOW, max(WIDTHS) * dim), (e.strides[0], dim * e.itemsize, e.itemsize))
    return np.ascontiguousarray(view)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def train(raws: list[bytes], langs: list[str], cfg: Training) -> dict:
    """Adam on cross-entropy; classes weigh alike. A dict of plain arrays."""
    labels = sorted(set(langs))
    if not labels:
        return {"labels": []}
    rng = np.random.default_rng(cfg.seed)
    order = sorted(range(len(raws)), key=lambda i: (langs[i], raws[i]))   # not by arrival
    x, y = _matrix([raws[i] for i in order]), np.array([labels.index(langs[i]) for i in order])
    weight = (len(y) / (len(labels) * np.bincount(y, minlength=len(labels)))).astype(np.float32)
    n_f, dim = len(WIDTHS) * cfg.filters, cfg.embedding
    mask = _mask(cfg.filters, dim)
    p = {"emb": rng.normal(0, 0.5, (256, dim)), "conv": rng.normal(0, 0.3, mask.shape) * mask,
         "bias": np.zeros(n_f), "out": rng.normal(0, 0.1, (n_f, len(labels))), "top": np.zeros(len(labels))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    p["emb"][0] = 0
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for epoch in range(cfg.epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // cfg.batch)):
            if not len(at):
                continue
            xb, yb = x[at], y[at]
            cols = _columns(xb, p["emb"])
            conv = cols @ p["conv"]
            best = conv.argmax(axis=1)                                   # (n, filters)
            pooled = np.take_along_axis(conv, best[:, None], 1)[:, 0] + p["bias"]
            act = np.maximum(pooled, 0)
            prob = _softmax(act @ p["out"] + p["top"])
            d = prob.copy()
            d[np.arange(len(yb)), yb] -= 1
            d *= weight[yb][:, None] / len(yb)
            g = {"out": act.T @ d, "top": d.sum(0)}
            da = (d @ p["out"].T) * (pooled > 0)
            g["bias"] = da.sum(0)
            picked = cols[np.arange(len(xb))[:, None], best]             # (n, filters, 4*dim)
            g["conv"] = np.einsum("nfk,nf->kf", picked, da) * mask
            dcol = da[:, :, None] * p["conv"].T[None]                    # (n, filters, 4*dim)
            ge = np.zeros_like(p["emb"])
            for w in range(max(WIDTHS)):
                pos = best + w
                byte = np.where(pos < WINDOW, np.take_along_axis(xb, np.minimum(pos, WINDOW - 1), 1), 0)
                np.add.at(ge, byte.ravel(), dcol[:, :, w * dim:(w + 1) * dim].reshape(-1, dim))
            ge[0] = 0
            g["emb"] = ge
            step += 1
            rate = cfg.rate * (1 - 0.9 * epoch / cfg.epochs)
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] -= (rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return {"labels": labels, **p}


def fit(docs: DataFrame, cfg: Training | None = None, id_col="doc_id", text_col="text", lang_col="lang") -> dict:
    """Train on the bounded sample; at most ``docs_per_lang * windows_per_doc``
    windows of 256 bytes per language reach the driver."""
    cfg = cfg or Training()
    rows = training_windows(docs, cfg, id_col, text_col, lang_col).collect()
    return train([bytes(r.raw) for r in rows], [r.lang for r in rows], cfg)


class _Net:
    BATCH = 128

    def __init__(self, model: dict):
        self.m = model

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of (n, WINDOW) byte windows."""
        m, out = self.m, []
        for i in range(0, len(x), self.BATCH):
            conv = _columns(x[i:i + self.BATCH], m["emb"]) @ m["conv"]
            out.append(_softmax(np.maximum(conv.max(axis=1) + m["bias"], 0) @ m["out"] + m["top"]))
        return np.concatenate(out)

    def texts(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text."""
        buf, offsets = tn.as_bytes(col)
        n = len(offsets) - 1
        lang, score = [UNDETERMINED] * n, np.zeros(n)
        if not self.m["labels"] or not n:
            return lang, score
        size = np.diff(offsets)
        count = -(-size // WINDOW)
        row = np.repeat(np.arange(n), count)
        if not len(row):
            return lang, score
        k = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1], count)
        start = offsets[row] + k * WINDOW
        held = np.minimum(WINDOW, offsets[row + 1] - start)
        low = np.concatenate([tn.lower_ascii(buf), np.zeros(WINDOW, np.uint8)])
        prob = np.zeros((n, len(self.m["labels"])))
        for i in range(0, len(row), 8 * self.BATCH):
            s, h, r = (a[i:i + 8 * self.BATCH] for a in (start, held, row))
            x = low[s[:, None] + np.arange(WINDOW)]
            x[np.arange(WINDOW) >= h[:, None]] = 0
            np.add.at(prob, r, self.windows(x) * h[:, None])
        prob /= np.maximum(size, 1)[:, None]
        letter = ((buf | 32) >= 97) & ((buf | 32) <= 122)
        total = np.concatenate([[0], np.cumsum(letter)])
        some = total[offsets[1:]] > total[offsets[:-1]]
        for i in np.flatnonzero(~some & (size > 0)):
            some[i] = any(c.isalpha() for c in buf[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
        best = prob.argmax(axis=1)
        for i in np.flatnonzero(some):
            lang[i] = self.m["labels"][best[i]]
            score[i] = min(1.0, prob[i, best[i]])
        return lang, score


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every row."""
    ship_by_value(__name__, "curatio.llm.textnum")
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        net = _Net(shared.value)
        for batch in batches:
            for part in tn.chunks(batch, "text"):
                lang, score = net.texts(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(lang, pa.string()), pa.array(score)], [id_col, "lang_pred", "score"])

    return src.mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double")


def keep(docs: DataFrame, model: dict, min_score: float, text_col: str = "text") -> DataFrame:
    """The input rows, whole and unchanged, whose language is determined with
    at least ``min_score``."""
    ship_by_value(__name__, "curatio.llm.textnum")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        net = _Net(shared.value)
        for batch in batches:
            for part in tn.chunks(batch, text_col):
                lang, score = net.texts(part.column(text_col))
                ok = np.array([x != UNDETERMINED for x in lang], bool) & (score >= min_score)
                yield part.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)
