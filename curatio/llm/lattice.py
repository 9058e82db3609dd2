"""All segmentations of words into the pieces of a vocabulary.

The lattice of a word has an arc for every piece that stands in it (the word
begins with the space mark) and, for every character, an arc that spells it in
byte pieces. The forward recursion in log space sums the weights of all paths;
the share of each arc in its end's sum, followed back from the end of the word,
gives the expected number of uses of every piece.
Words of similar length are computed together, place by place, over the arcs
that they have: a start is followed only as far as some piece goes on."""

from __future__ import annotations

import numpy as np

SPACE = "▁"
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
#: Characters of words that are computed together (one word at least).
_TOGETHER = 1 << 16
_POINTS = 0x110000


class Pieces:
    """A public SentencePiece vocabulary: pieces with their scores, bytes."""

    def __init__(self, model: bytes, longest: int = 16):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = sp.get_piece_size()
        self.score = np.array([sp.get_score(i) for i in range(self.size)])
        self.byte = np.zeros(256, np.int64)
        usable = []
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and 0 < len(piece) <= longest:
                usable.append((piece, i))
        self.used = np.array(sorted({i for _, i in usable} | set(self.byte.tolist())), np.int64)
        self.longest = max(len(p) for p, _ in usable)
        self.tables = self._tables(*self._prefixes(usable))

    @staticmethod
    def _prefixes(usable: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each prefix of a piece; twice the piece that it is, plus one
        (0 for none), and one more if longer pieces begin with it."""
        size = np.array([len(p) for p, _ in usable], np.int64)
        ids = np.array([i for _, i in usable], np.int64)
        points = np.frombuffer("".join(p for p, _ in usable).encode("utf-32-le"), np.uint32).astype(U)
        begin = np.cumsum(size) - size
        h, keys, values = np.zeros(len(size), U), [], []
        with np.errstate(over="ignore"):
            for n in range(1, int(size.max()) + 1):
                live = size >= n
                h, begin, size, ids = h[live], begin[live], size[live], ids[live]
                h = h * _BASE + points[begin + n - 1] + U(1)
                keys.append(h)
                values.append(np.where(size == n, 2 * (ids + 1), 0) + (size > n))
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        flat = np.concatenate(values)
        piece, more = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        np.maximum.at(piece, at, flat >> 1)
        np.maximum.at(more, at, flat & 1)
        return key, 2 * piece + more

    @staticmethod
    def _tables(key: np.ndarray, value: np.ndarray, bits: int = 18) -> list[tuple]:
        """Direct-mapped tables; a key whose slot is taken goes to the next."""
        out = []
        while len(key):
            odd = U(((int(_BASE) << 1) * (len(out) + 3) + 1) % (1 << 64))            # another mix each time
            with np.errstate(over="ignore"):
                slot, first = np.unique((key * odd) >> U(64 - bits), return_index=True)
            keys, values = np.zeros(1 << bits, U), np.full(1 << bits, -1, np.int32)
            keys[slot], values[slot] = key[first], value[first]
            out.append((odd, keys, values))
            left = np.ones(len(key), bool)
            left[first] = False
            key, value = key[left], value[left]
        return out

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece of each hash (-1 for none), and whether longer ones begin so."""
        out, left = np.zeros(len(h), np.int32), np.arange(len(h))
        for odd, key, value in self.tables:
            mine = h[left]
            slot = (mine * odd) >> U(65 - len(key).bit_length())
            got, hit = value[slot], key[slot] == mine
            hit &= got >= 0
            out[left[hit]] = got[hit]
            left = left[~hit & (got >= 0)]              # an empty slot: no key of it in later tables
            if not len(left):
                break
        return (out >> 1) - 1, (out & 1).astype(bool)

    def first_weights(self) -> np.ndarray:
        """Log probabilities made from the scores of the file: as they are in
        a unigram vocabulary, by rank where the scores are ranks."""
        s = self.score[self.used]
        w = -np.log(1.0 - s) if np.all(s == np.floor(s)) else s
        out = np.full(self.size, -np.inf)
        out[self.used] = w - np.logaddexp.reduce(w)
        return out


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    text = SPACE + SPACE.join(words)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return points, np.array([len(w) + 1 for w in words], np.int64)


class Lattice:
    def __init__(self, pieces: Pieces, weights: np.ndarray):
        self.pieces, self.w = pieces, np.append(weights, -np.inf)       # index -1: no piece
        self.number = np.full(_POINTS, -1, np.int32)    # of each character met
        self.chars = np.zeros(0, np.int64)
        self.piece, self.more = np.zeros(0, np.int32), np.zeros(0, bool)
        self.spelled, self.single = np.zeros(0), np.zeros(0)

    def _numbered(self, points: np.ndarray) -> np.ndarray:
        """Number of each character; new ones get their weight as byte pieces,
        and the one that a piece of this character adds to."""
        at = self.number[points]
        if (at < 0).any():
            new = np.unique(points[at < 0])
            self.number[new] = len(self.chars) + np.arange(len(new))
            with np.errstate(over="ignore"):
                piece, more = self.pieces.find(new.astype(U) + U(1))
            spelled = np.array([sum(self.w[self.pieces.byte[b]] for b in chr(c).encode("utf-8", "replace")) for c in new.tolist()])
            for name, x in (("chars", new), ("piece", piece), ("more", more), ("spelled", spelled),
                            ("single", np.logaddexp(self.w[piece], spelled))):
                setattr(self, name, np.concatenate([getattr(self, name), x]))
            at = self.number[points]
        return at

    def run(self, words: list[str], counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log marginal of each word; with counts, too, the expected uses of
        every piece in so many occurrences."""
        out = np.zeros(len(words))
        uses = None if counts is None else np.zeros(self.pieces.size + 1)
        if not words:
            return out, uses
        points, size = _code_points(words)
        begin = np.cumsum(size) - size
        order = np.argsort(-size, kind="stable")
        upto = np.cumsum(size[order])
        a = 0
        while a < len(order):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + _TOGETHER, "right")))
            g = order[a:b]
            out[g] = self._together(points, begin[g], size[g], None if counts is None else counts[g], uses)
            a = b
        return out, uses

    def _arcs(self, h, start, at, after, points, n_words):
        """(start, end, piece) of the arcs of two characters and more. ``at``
        is the character that an arc has last, ``after`` the next one of each."""
        out = []
        with np.errstate(over="ignore"):
            points = points.astype(U) + U(1)
            while len(at):
                at = after[at]
                live = np.flatnonzero(at >= 0)
                at, start = at[live], start[live]
                h = h[live] * _BASE + points[at]
                piece, more = self.pieces.find(h)
                hit = np.flatnonzero(piece >= 0)
                out.append((start[hit], at[hit] + n_words, piece[hit]))
                go = np.flatnonzero(more)
                h, start, at = h[go], start[go], at[go]
        return out

    def _together(self, points, begin, size, counts, uses):
        """Words in falling order of length. Nodes are numbered by place, then by
        word, so that the nodes of a place and the arcs to them are adjacent;
        the character before a node has its number, less the number of words."""
        k, n = len(size), int(size[0])
        alive = np.searchsorted(-size, -np.arange(n + 1), "right")       # words of that length at least
        base = np.concatenate([[0], np.cumsum(alive)])
        place = np.repeat(np.arange(1, n + 1), alive[1:])
        word = np.arange(len(place)) + k - base[place]
        before = base[place - 1] + word
        after = np.where(place < size[word], base[np.minimum(place + 1, n)] + word - k, -1)
        chars = points[begin[word] + place - 1]
        number = self._numbered(chars)
        go = np.flatnonzero(self.more[number])
        more = self._arcs(chars[go].astype(U) + U(1), before[go], go, after, chars, k)
        start, end = (np.concatenate([x, *[m[i] for m in more]]) for i, x in enumerate((before, np.arange(len(place)) + k)))
        weight = np.concatenate([self.single[number], *[self.w[m[2]] for m in more]])
        order = np.argsort(end, kind="stable")
        start, weight = start[order], weight[order]
        into = np.bincount(end - k, minlength=len(place))                # one arc of one character at least
        first = np.concatenate([[0], np.cumsum(into)])
        share = None if uses is None else np.zeros(len(start))
        fore = np.zeros(base[-1])
        with np.errstate(divide="ignore", invalid="ignore"):
            for j in range(1, n + 1):
                c, d = base[j] - k, base[j + 1] - k
                a, b = first[c], first[d]
                many, at = into[c:d], first[c:d] - a
                x = fore[start[a:b]] + weight[a:b]
                top = np.maximum.reduceat(x, at)
                top[np.isneginf(top)] = 0
                x = np.exp(x - np.repeat(top, many))
                total = np.add.reduceat(x, at)
                fore[c + k:d + k] = top + np.log(total)
                if share is not None:
                    share[a:b] = x / np.repeat(np.where(total > 0, total, 1), many)
        last = base[size] + np.arange(k)
        if uses is None:
            return fore[last]
        through = np.zeros(base[-1])                                     # expected passages of each node
        through[last] = counts
        for j in range(n, 0, -1):
            c, d = base[j] - k, base[j + 1] - k
            a, b = first[c], first[d]
            share[a:b] *= np.repeat(through[c + k:d + k], into[c:d])
            np.add.at(through, start[a:b], share[a:b])
        passed = np.empty(len(share))
        passed[order] = share
        if more:
            uses += np.bincount(np.concatenate([m[2] for m in more]), passed[len(place):], len(uses))
        self._single(number, passed[:len(place)], uses)
        return fore[last]

    def _single(self, number, passed, uses):
        """Arcs of one character: shared by its piece and its bytes."""
        for c, x in enumerate(np.bincount(number, passed, len(self.chars)).tolist()):
            if x > 0:
                if self.piece[c] >= 0:
                    uses[self.piece[c]] += x * np.exp(self.w[self.piece[c]] - self.single[c])
                for b in chr(self.chars[c]).encode("utf-8", "replace"):
                    uses[self.pieces.byte[b]] += x * np.exp(self.spelled[c] - self.single[c])
