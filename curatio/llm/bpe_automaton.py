"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled, in order, into a deterministic automaton over token
labels. It starts as one state that loops on every base symbol. The merge
``u v -> w`` adds a gadget: the state that ``u`` leads to is split off without
its arc ``v``, and every state with the path ``u v`` gets an arc ``w`` to where
that path led. Afterwards the label sequences that the automaton accepts are
exactly the correct tokenizations. As the target of an arc depends on its
label alone, a state is kept as the label that leads to it, with the version
(merge number) from which it was copied and the versions at which its arcs
were closed; arcs are looked up in a table that is filled on first use.

Encoding walks a pre-split word once, symbol by symbol: the tokenization of
each prefix is unique, so there is one arc whose label ends at the symbol, and
the path to each prefix is kept in a transition table that words with equal
beginnings share. Decoding emits the arc labels.

The vocabulary is a ``tokenizers`` JSON file of the kind "words with a
word-end mark": NFC, runs of white space to one space, lower case per
character, split by the file's pattern, byte-level symbols."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from curatio.llm import textnum as tn
from curatio.operators.util import ship_by_value

#: Words that one task keeps encoded.
CACHE_WORDS = 250_000
#: Word beginnings whose paths one task keeps.
PREFIXES = 400_000
#: Words beyond this many symbols are walked in one go, outside the tables.
LONG_WORD = 200


def byte_symbols() -> dict[int, str]:
    """Byte values to the printable characters of byte-level vocabularies:
    printable Latin-1 stands for itself, the rest for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + n) for n, b in enumerate(rest)}


class Automaton:
    """States are labels (token ids); -1 is the start, from where every live
    label leads on."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab, self.suffix = vocab, suffix
        self.text = {i: t for t, i in vocab.items()}
        self.born: dict[int, int] = {}                 # label -> its merge
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.closed: dict[tuple[int, int], int] = {}   # (state, label) -> merge that closed the arc
        self.arcs: dict[tuple[int, int], bool] = {}
        self.prefixes: dict[str, tuple[int, ...]] = {}
        self.dead: set[int] = set()
        self.longest = 1
        for k, (a, b) in enumerate(merges):
            self._gadget(k, vocab[a], vocab[b], vocab[a + b])
        self.arcs.clear()
        self.longest = max(map(len, vocab), default=1)

    def _gadget(self, k: int, u: int, v: int, w: int) -> None:
        if w in self.born:                             # a label is made once
            return
        self.born[w], self.left[w], self.right[w] = k, u, v
        if u in self.dead or v in self.dead or not self._open(u, v, k):
            self.dead.add(w)                           # no path u v is left
        else:
            self.closed.setdefault((u, v), k)

    def _open(self, x: int, y: int, before: int) -> bool:
        """Had the state after label ``x`` an arc ``y`` just before that merge?"""
        shut = self.closed.get((x, y))
        if shut is not None and shut < before:
            return False
        bx, by = self.born.get(x, -1), self.born.get(y, -1)
        if by >= before or bx >= before:
            return False
        if by > bx:        # the arc came with y's gadget, if x had the path to it
            if x == self.left[y] == self.right[y]:
                return False                           # u u -> w: u was split off before w came
            return self._open(x, self.left[y], by)
        if bx > by:        # the state was copied from that of x's right part
            return self._open(self.right[x], y, bx)
        if bx >= 0:        # the same label twice: both of the above
            return self._open(self.right[x], self.left[y], bx)
        return True        # two base symbols

    def arc(self, x: int, y: int) -> bool:
        if x < 0:
            return y not in self.dead
        key = (x, y)
        got = self.arcs.get(key)
        if got is None:
            if len(self.arcs) > 2_000_000:
                self.arcs.clear()
            got = self.arcs[key] = y not in self.dead and self._open(x, y, 1 << 60)
        return got

    def _step(self, symbols: str, i: int, end: str) -> tuple[int, ...]:
        """Tokenization of ``symbols[:i]``, given those of its prefixes."""
        get, table, arcs = self.vocab.get, self.prefixes, self.arcs
        # shortest label first: most labels have few symbols
        for s in range(i - 1, max(-1, i - 1 - self.longest), -1):
            t = get(symbols[s:i] + end)
            if t is not None:
                if not s:
                    if t not in self.dead:
                        return (t,)
                    continue
                pre = table[symbols[:s]]
                key = (pre[-1], t)
                ok = arcs.get(key)
                if ok or ok is None and self.arc(*key):
                    return (*pre, t)
        raise ValueError("the vocabulary lacks a base symbol")

    def encode(self, symbols: str) -> tuple[int, ...]:
        """Token ids of one pre-split word given in byte symbols: from the
        longest prefix whose tokenization the table holds, symbol by symbol."""
        n, table = len(symbols), self.prefixes
        if n == 0:
            return ()
        if n > LONG_WORD:
            return self._walk(symbols)
        if len(table) > PREFIXES:
            table.clear()
        i = n - 1
        while i > 0 and symbols[:i] not in table:
            i -= 1
        for j in range(i + 1, n):
            table[symbols[:j]] = self._step(symbols, j, "")
        return self._step(symbols, n, self.suffix)

    def _walk(self, symbols: str) -> tuple[int, ...]:
        """The same for one long word, in linear memory."""
        n, get = len(symbols), self.vocab.get
        state, origin = [-1] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            end = self.suffix if i == n else ""
            for s in range(i - 1, max(-1, i - 1 - self.longest), -1):
                t = get(symbols[s:i] + end)
                if t is not None and self.arc(state[s], t):
                    state[i], origin[i] = t, s
                    break
            else:
                raise ValueError("the vocabulary lacks a base symbol")
        out, i = [], n
        while i:
            out.append(state[i])
            i = origin[i]
        return tuple(out[::-1])

    def labels(self, ids) -> list[str]:
        return [self.text[i] for i in ids]


#: Unicode's White_Space (fixed values).
SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def space_of(top: int) -> str:
    """The white space up to a code point, for a pattern's class."""
    return "".join(rf"\x{c:02x}" if c < 256 else rf"\u{c:04x}" for c in SPACE if c <= top)


class Codec:
    """A tokenizers JSON file as normaliser, splitter and automaton."""

    def __init__(self, raw: bytes):
        import regex
        spec = json.loads(raw)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace(r"\s", space_of(0x10FFFF))).findall
        self.symbols = byte_symbols()
        self.text, self.digits = self.automaton.text, {i: str(i) for i in self.automaton.text}
        # Latin-1 texts take the standard library's matcher, which is faster
        latin = {c: unicodedata.category(chr(c))[0] for c in range(256)}
        klass = {k: "".join(rf"\x{c:02x}" for c, kind in latin.items() if kind == k) for k in "LN"}
        self.latin = re.compile(pattern.replace(r"\s", space_of(255)).replace(r"[\p{L}]+", f"[{klass['L']}]+")
                                .replace(r"[\p{N}]", f"[{klass['N']}]")
                                .replace(r"\p{L}\p{N}", klass["L"] + klass["N"])).findall \
            if pattern.count(r"\p{") == 4 else None
        self.ids, self.labels = _Recent(self.ids_of), _Recent(self.labels_of)

    def split(self, text: str) -> list[str]:
        if self.latin:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                pass
            else:
                return self.latin(text)
        return self.pieces(text)

    def normalise(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()   # lower case of each character by itself

    def ids_of(self, w: str) -> str:
        ids = self.automaton.encode(w.encode("utf-8").decode("latin-1").translate(self.symbols))
        self.labels.put(w, " ".join([self.text[i] for i in ids]))
        return " ".join([self.digits[i] for i in ids])

    def labels_of(self, w: str) -> str:
        return " ".join(self.automaton.labels(map(int, self.ids[w].split(" "))))

    def run(self, text: str):
        """(number of ids, ids joined by spaces, decoded text)."""
        ids, labels = [], []
        parts = self.special_split.split(text) if self.special_split and "<|" in text else [text]
        for part in parts:
            if part in self.special:
                ids.append(str(self.special[part]))
                labels.append(part)
            elif part:
                words = self.split(self.normalise(part))
                ids += map(self.ids.__getitem__, words)
                labels += map(self.labels.__getitem__, words)
        joined = " ".join(ids)
        return joined.count(" ") + 1 if ids else 0, joined, " ".join(labels)


class _Recent(dict):
    """Results by word, of two generations: what is used stays when the older
    half goes."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, w: str) -> str:
        got = self.old.get(w)
        if got is None:
            got = self.make(w)
        self.put(w, got)
        return got

    def put(self, w: str, got: str) -> None:
        if len(w) <= 64:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[w] = got


def encode_documents(docs: DataFrame, vocabulary: bytes, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """Each row's token ids and their decoded text; with ``digests`` the
    SHA-256 of both instead.

    One ``mapInArrow``, no shuffle; the vocabulary file's bytes (a fixed
    public file) are broadcast, memory is bounded by the text chunk and the
    word cache. Null text counts as empty: no ids. Repeated rows give equal
    results, an empty table none; null ids are carried; other columns are
    ignored."""
    ship_by_value(__name__, "curatio.llm.textnum")
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    id_type = src.schema["id"].dataType.simpleString()

    def sha(s: str) -> str:
        return hashlib.sha256(s.encode("utf-8")).hexdigest()

    def run(batches):
        codec = Codec(shared.value)
        for batch in batches:
            for part in tn.chunks(batch, "text"):
                n, ids, texts = [], [], []
                for t in part.column("text"):
                    k, i, d = codec.run(t.as_py() or "")
                    n.append(k)
                    ids.append(sha(i) if digests else [int(x) for x in i.split()])
                    texts.append(sha(d) if digests else d)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()),
                     pa.array(ids, pa.string() if digests else pa.list_(pa.int32())), pa.array(texts, pa.string())],
                    names)

    names = [id_col, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
    kinds = ("string", "string") if digests else ("array<int>", "string")
    return src.mapInArrow(run, f"`{id_col}` {id_type}, n_tokens long, {names[2]} {kinds[0]}, {names[3]} {kinds[1]}")
