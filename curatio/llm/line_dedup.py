"""Line dedup by a segment-partition edit join, in DataFrame functions alone.

A line is removed when an equal line, or one within ``threshold`` edits,
stands earlier in the corpus (by document id, hash of the text, line number). Equal lines
collapse into classes first. Of two classes within the threshold the shorter
is cut into ``threshold + 1`` segments, one of which must occur unchanged in
the longer; the index holds (length, segment number, segment) of each class,
and each class probes the lengths and the few start positions that the
threshold leaves open. Counts of frequent letters bound the distance from
below inside the join, so classes that only share a segment are not emitted.
What remains is verified exactly by a bit-parallel automaton over the
``2 * threshold + 1`` diagonals of the band.

For longer lines the threshold grows with the length: a line is near, too,
within one changed word for each ``words_per_edit`` words of the shorter line
(:func:`word_edits`). The same segment method finds these over arrays of words, in
bands of length with one threshold each (:func:`near_by_words`).

Scale: narrow rows are shuffled by class and by segment key; copies meet in a
map-side aggregate, so a line that a third of all documents hold is one row
per task; texts are shuffled once for the classes and once to write the
result. Lines shorter than ``min_chars`` code points take no part in the near
join; equal ones are removed like any others.

Defined results: null text stays null and has no lines, empty text stays
empty; blank lines are kept; rows that repeat a document id and its text are
one document and get equal results; rows of one id, or without one, whose texts
differ are different documents; null ids sort first;
an empty table gives no rows; columns other than id and text are ignored by
:func:`line_dedup` and carried by :func:`apply`."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.scratch import Scratch

#: Letters whose counts bound the distance from below, in two halves.
LETTERS = ("abcdefghijklm", "nopqrstuvwxyz")
_BITS = 4
#: Nearly all values of the written tables differ, so dictionaries would not pay;
#: with small pages a range of hashes is read without the pages beside it.
_TABLES = {"parquet.enable.dictionary": "false", "parquet.page.row.count.limit": "2000"}
#: Verified pairs are looked up by a broadcast of their keys up to this many.
BROADCAST_KEYS = 200_000


@dataclass(frozen=True)
class LineRules:
    threshold: int = 2
    min_chars: int = 20
    words_per_edit: int = 20


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, line_no, line) of every line that is not blank; ``t`` is the
    hash of the whole text, which tells documents of one id apart."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("t"))
    return (src.select("id", "t", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .filter(_has_ink(F.col("line"))))


def _has_ink(line: Column) -> Column:
    """Is a line more than blanks? The first byte tells for most lines."""
    return (line >= "!") | line.rlike("\\S")


def _keyed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("h", F.xxhash64("line"))


def classes_of(lines: DataFrame) -> DataFrame:
    """One row per distinct line: its key, first place, number of places, text."""
    return (_keyed(lines).groupBy("h")
            .agg(F.min(F.struct("id", "t", "line_no")).alias("first"), F.count(F.lit(1)).alias("n"),
                 F.first("line").alias("line")))


def _letters(half: int, text: str = "line") -> Column:
    """Counts of thirteen letters, four bits each."""
    total = F.lit(0).cast("long")
    for k, c in enumerate(LETTERS[half]):
        # a letter is one byte, whatever stands beside it
        n = F.octet_length(F.col(text)) - F.octet_length(F.replace(F.col(text), F.lit(c), F.lit("")))
        total = total + F.shiftleft(F.pmod(n, F.lit(1 << _BITS)).cast("long"), k * _BITS)
    return total


#: The highest bit of each count, and every other count.
_TOPS = sum(8 << k * _BITS for k in range(len(LETTERS[0])))
_EVEN = sum(15 << k * _BITS for k in range(0, len(LETTERS[0]), 2))


def _differences(a: Column, b: Column) -> Column:
    """Sum of the differences of thirteen counts modulo 16, the shorter way
    round, all counts at once: one by one they made more code than the JVM compiles."""
    tops = F.lit(_TOPS)
    less = (a.bitwiseOR(tops) - b.bitwiseAND(F.lit(~_TOPS))).bitwiseXOR(a.bitwiseXOR(F.bitwise_not(b)).bitwiseAND(tops))   # a - b in each
    back = less.bitwiseAND(tops)                                                                  # 8 to 15 are 8 to 1 the other way
    ones = F.shiftright(back, _BITS - 1)
    way = less.bitwiseXOR(F.shiftleft(back, 1) - ones) + ones
    pairs = way.bitwiseAND(F.lit(_EVEN)) + F.shiftright(way, _BITS).bitwiseAND(F.lit(_EVEN))
    return F.pmod(pairs, F.lit(255))                                                              # sum of its bytes


def _bags_near(most: Column) -> Column:
    """Could the counts of ``sig0_a``, ``sig1_a`` and of ``sig0_b``, ``sig1_b`` (letters or classes of words,
    four bits each) stem from lists within so many edits? One edit changes one
    count by one, or two counts by one each; counts are known modulo 16, which
    can only make them look nearer."""
    return _differences(F.col("sig0_a"), F.col("sig0_b")) + _differences(F.col("sig1_a"), F.col("sig1_b")) <= 2 * most


def char_rows(classes: DataFrame, rules: LineRules) -> DataFrame:
    """(h, key, own): a row for each place of each line at which a segment of a
    shorter line may stand; ``own`` marks the line's own segments, which are
    the index. Lengths form bands of an eighth at most; ``tau + 1`` segments
    make up the least length ``lo`` of a line's band, half of them counted from
    the start of the line and half from its end.

    The shorter line of a pair has a first segment up to which no more edits lie
    than segments stand before it: it is unchanged, and moved by its number at
    most; counted from the end, by the number of segments after it at most."""
    tau, n = rules.threshold, F.col("n")
    width = lambda m: F.call_function("shiftleft", F.lit(1), F.greatest(F.length(F.bin(m)) - 4, F.lit(0)))
    band = lambda m: m - F.pmod(m, width(m))
    places = [F.struct(F.lit(i).alias("i"), F.lit(d).alias("d"), F.lit(tau + 1 - i if 2 * i > tau else 0).alias("back"))
              for i in range(tau + 1) for d in range(-min(i, tau - i), min(i, tau - i) + 1)]
    rows = classes.select("h", "line", F.length("line").alias("n")).filter(n >= rules.min_chars)
    lows = F.array_distinct(F.array(*[band(F.greatest(n - k, F.lit(rules.min_chars))) for k in range(tau + 1)]))
    rows = rows.select("h", "line", "n", F.explode(lows).alias("lo"))
    rows = rows.select("h", "line", "n", "lo", (F.col("lo") == band(n)).alias("low"), F.explode(F.array(*places)).alias("p"))
    size, p = F.expr(f"lo div {tau + 1}").cast("int"), F.col("p")
    rows = rows.select("h", "line", "n", "lo", "low", "p", size.alias("size"), (
        F.when(p["back"] > 0, n - p["back"] * size).otherwise(p["i"] * size) + p["d"]).alias("at"))
    rows = rows.filter((F.col("at") >= 0) & (F.col("at") + F.col("size") <= n))
    return rows.select("h", F.xxhash64("lo", "p.i", F.substring(F.col("line"), F.col("at") + 1, F.col("size"))).alias("key"),
                       ((F.col("p.d") == 0) & F.col("low")).alias("own"))


#: Keys that more lines hold than this are dealt over tasks, found in one line
#: of ``_SAMPLE``; so many keys at most are told to all tasks.
_CROWD, _SAMPLE, _CROWDED_KEYS = 2048, 64, 100_000


def met_rows(rows: DataFrame, scratch: Scratch, name: str, indexed: bool = False) -> DataFrame:
    """The rows (key, h, own) whose key lines of different classes have: index
    and probes meet in one shuffle of narrow rows. Rows of a crowded key are
    split over tasks; they all stay, as others hold that key for certain. With
    ``indexed`` keys go that only probes have: each pair within the threshold
    has a key that is the shorter line's own."""
    # hashes below a bound are as good a sample as any, and written tables of classes are sorted by them
    crowded = (rows.filter(F.col("h") < -2 ** 63 + 2 ** 64 // _SAMPLE).groupBy("key").agg(F.count(F.lit(1)).alias("k"))
               .filter(F.col("k") >= _CROWD // _SAMPLE).orderBy(F.desc("k"), "key").limit(_CROWDED_KEYS).select("key"))
    crowded = scratch.put(crowded.withColumn("crowded", F.lit(True)), f"{name}-crowded")
    # one long to sort by; keys that share a place by chance are told apart below
    if crowded.isEmpty():
        rows = rows.select(F.col("key").alias("place"), "h", "own", F.lit(None).cast("long").alias("crowd"))
    else:
        crowd = F.when(F.col("crowded"), F.col("key"))
        rows = rows.join(F.broadcast(crowded), "key", "left").select(
            F.when(F.col("crowded"), F.xxhash64("key", F.pmod("h", F.lit(_SAMPLE)))).otherwise(F.col("key")).alias("place"),
            "h", "own", crowd.alias("crowd"))
    place = Window.partitionBy("place")
    shared = F.min("h").over(place) != F.max("h").over(place)
    if indexed:
        shared = shared & F.max("own").over(place)
    met = (rows.withColumn("shared", shared).filter(F.col("crowd").isNotNull() | F.col("shared"))
           .withColumn("key", F.coalesce("crowd", "place")))
    # a line of repeated words has the same segment at many places
    met = scratch.put(met.groupBy("key", "h").agg(F.max("own").alias("own")), name)
    scratch.drop(f"{name}-crowded")
    return met


def within(ca: Column, cb: Column, tau: int) -> Column:
    """Edit distance of two character arrays at most ``tau``, by bits: bit
    ``j`` of the state with e errors says that the characters read of ``cb``
    are matched with ``j - tau`` more of ``ca``. All diagonals of the band
    advance at once with each character. The arrays must be stored columns,
    as an expression in their place would be evaluated for each character."""
    full = (1 << (2 * tau + 1)) - 1
    start = F.struct(*[F.lit(sum(1 << (tau + p) for p in range(e + 1))).alias(f"r{e}") for e in range(tau + 1)])

    def advance(state, match):
        out = []
        for e in range(tau + 1):
            new = state[f"r{e}"].bitwiseAND(match)
            if e:
                old = state[f"r{e - 1}"]
                new = (new.bitwiseOR(old).bitwiseOR(F.shiftright(old, 1))
                       .bitwiseOR(F.shiftleft(out[-1], 1)).bitwiseAND(F.lit(full)))
            out.append(new)
        return F.struct(*[c.alias(f"r{e}") for e, c in enumerate(out)])

    def step(state, i):
        match = F.lit(0)
        for j in range(2 * tau + 1):
            # get() counts from 0 and is null outside, which is no match
            same = F.get(ca, i + (j - tau)) == F.get(cb, i)
            match = match.bitwiseOR(F.when(same, F.lit(1 << j)).otherwise(F.lit(0)))
        return F.transform(F.array(match), lambda m: advance(state, m))[0]     # binds m, evaluated once

    n = F.size(cb)
    last = F.when(n == 0, start).otherwise(F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), start, step))
    bit = F.size(ca) - n + tau
    return ((bit >= 0) & (bit <= 2 * tau)
            & (F.call_function("shiftright", last[f"r{tau}"], F.least(F.greatest(bit, F.lit(0)), F.lit(2 * tau)))
               .bitwiseAND(F.lit(1)) == 1))


#: From so many edits on, bands double and segments are looked for anywhere.
_LONG = 16


def words_of(line: Column) -> Column:
    """Runs of characters that aren't blank; characters, where these are of
    three bytes in the main, as in scripts that put no blanks between words."""
    wide = F.octet_length(line) >= 2 * F.length(line)
    plain = ~F.greatest(*[F.contains(line, F.lit(c)) for c in "\t\x0b\x0c\r"])          # one character needs no regex to split at
    return F.array_remove(F.when(wide, F.split(line, "")).when(plain, F.split(line, " "))
                          .otherwise(F.split(line, "[ \\t\\x0B\\f\\r]+")), "")


def word_edits(n: Column, rules: LineRules) -> Column:
    """Words that may differ where the shorter line has ``n``."""
    return F.floor(n / F.lit(rules.words_per_edit)).cast("int")


def _band(m: Column, rules: LineRules) -> Column:
    """Least number of words of the band of ``m``: lengths of one threshold; long
    lines between two powers of two."""
    per = rules.words_per_edit
    double = F.call_function("shiftleft", F.lit(_LONG * per), F.length(F.bin(F.floor(m / F.lit(_LONG * per)))) - 1)
    return F.when(m < _LONG * per, m - F.pmod(m, F.lit(per))).otherwise(double).cast("int")


def word_rows(classes: DataFrame, rules: LineRules) -> DataFrame:
    """(h, key, own) as :func:`char_rows` has it, over words. A band's lines
    have one segment more than its largest threshold. In long lines a segment
    is looked for at every place, as most places are within the shift anyway."""
    per, n, lo, i, d = rules.words_per_edit, F.col("n"), F.col("lo"), F.col("i"), F.col("d")
    rows = classes.select("h", F.explode(F.array(words_of(F.col("line")))).alias("words"))    # found once
    rows = rows.select("h", "words", F.size("words").alias("n")).filter(n >= per)
    # the bands of all lengths that a shorter line of a pair may have
    rows = rows.select("h", "words", "n", F.explode(F.sequence(F.greatest(n - word_edits(n, rules), F.lit(per)), n)).alias("m"),
                       F.greatest(n - word_edits(n, rules), F.lit(per)).alias("m0"))
    rows = rows.filter((F.col("m") == F.col("m0")) | (F.col("m") == _band(F.col("m"), rules)))
    rows = rows.select("h", "words", "n", _band(F.col("m"), rules).alias("lo"))
    long = lo >= _LONG * per
    tau = F.when(long, F.floor((2 * lo - 1) / F.lit(per))).otherwise(F.floor(lo / F.lit(per))).cast("int")
    rows = rows.select("h", "words", "n", "lo", tau.alias("tau"), F.floor(lo / (tau + 1)).cast("int").alias("size"),
                       (lo == _band(n, rules)).alias("low"))
    rows = rows.select("*", F.explode(F.when(long, F.sequence(F.lit(0), n - F.col("size")))
                                      .otherwise(F.sequence(F.lit(0), F.col("tau")))).alias("i"))
    most = F.least(i, F.col("tau") - i)
    rows = rows.select("*", F.explode(F.when(long, F.array(F.lit(0))).otherwise(F.sequence(-most, most))).alias("d"))
    rows = rows.withColumn("at", F.when(long, i).when(2 * i > F.col("tau"), n - (F.col("tau") + 1 - i) * F.col("size") + d)
                           .otherwise(i * F.col("size") + d))
    rows = rows.filter((F.col("at") >= 0) & (F.col("at") + F.col("size") <= n))
    own = F.when(long, (F.pmod(i, F.col("size")) == 0) & (F.floor(i / F.col("size")) <= F.col("tau"))).otherwise(d == 0)
    return rows.select("h", F.xxhash64("lo", F.when(long, F.lit(-1)).otherwise(i),
                                       F.slice("words", F.col("at") + 1, F.col("size"))).alias("key"),
                       (own & F.col("low")).alias("own"))


def _word_bag(words: Column) -> Column:
    """A letter for each word, by 26 classes of its hash; :func:`_letters` counts them."""
    first, size = F.lit(ord(LETTERS[0][0])).cast("long"), F.lit(2 * len(LETTERS[0]))
    return F.array_join(F.transform(words, lambda w: F.char(first + F.pmod(w, size))), "")


#: Words as single characters: so many code points from U+10000 on.
_CODES = 0x100000


def _text(points: Column) -> Column:
    units = F.transform(points, lambda c: F.lpad(F.hex(c + F.lit(0x10000).cast("long")), 8, "0"))
    return F.decode(F.unhex(F.array_join(units, "")), "UTF-32")


def _code_text(words: Column) -> Column:
    """A string with one character a word, told by 20 bits of its hash."""
    return _text(F.transform(words, lambda w: F.pmod(w, F.lit(_CODES).cast("long"))))


def words_within(a: str, b: str, most: Column) -> Column:
    """Edit distance of the word arrays ``words_<a>`` and ``words_<b>`` at most
    ``most``, by a bounded band. Characters by 20 bits of a hash (``code_``) give
    a bound from below, which is exact if the pair's words have as many
    characters; else each distinct word of the pair gets a character."""
    wa, wb, ca, cb = F.col(f"words_{a}"), F.col(f"words_{b}"), F.col(f"code_{a}"), F.col(f"code_{b}")
    bounded = lambda x, y: F.coalesce(F.call_function("levenshtein", x, y, most), F.lit(-1)) >= 0
    both = F.array_union(wa, wb)
    told = F.size(both) == F.size(F.array_distinct(F.transform(both, lambda w: F.pmod(w, F.lit(_CODES).cast("long")))))
    own = lambda words, al: _text(F.transform(words, lambda w: F.array_position(al, w)))
    exact = F.transform(F.array(both), lambda al: bounded(own(wa, al), own(wb, al)))[0]      # binds the alphabet once
    return F.when(~bounded(ca, cb), F.lit(False)).when(told, F.lit(True)).otherwise(exact)


def _near(met: DataFrame, lines: DataFrame, edits: Column, check, scratch: Scratch, name: str,
          bound: dict[str, Column] | None = None) -> DataFrame:
    """(h) of the classes that an earlier one is near to. Every class is held
    against the earliest of each of its keys first, so a large group of near
    copies costs as many pairs as it has members; only classes that this leaves
    open meet the others. ``lines``: (h, first, n, sig, and what ``check`` needs);
    ``bound``: columns that ``check`` needs and that are made once for each pair."""
    sigs = ("sig0", "sig1")
    rows = met.join(lines.select("h", "first", "n", *[F.get("sig", F.lit(k)).alias(c) for k, c in enumerate(sigs)]), "h")
    fit = (F.abs(F.col("n_a") - F.col("n_b")) <= edits) & _bags_near(edits)
    more = [c for c in lines.columns if c not in ("h", "first", "sig")]

    def side(k, *cols):
        return [F.col(c).alias(f"{c}_{k}") for c in ("first", "n", *sigs, *cols)]

    def verified(pairs):
        for k in "ab":
            pairs = pairs.join(lines.select(F.col("h").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in more]), k)
        for c, made in (bound or {}).items():
            pairs = pairs.select("*", F.explode(F.array(made)).alias(c))
        return pairs.filter(check).select(F.col("b").alias("h")).distinct()

    lead = rows.groupBy("key").agg(F.min(F.struct("first", "h", "n", *sigs)).alias("lead"))
    star = (rows.select("key", F.col("h").alias("b"), *side("b")).join(
        lead.select("key", F.col("lead.h").alias("a"), *[F.col(f"lead.{c}").alias(f"{c}_a") for c in ("n", *sigs)]), "key")
        .filter((F.col("a") != F.col("b")) & fit).select("a", "b").distinct())
    found = scratch.put(verified(star), f"{name}-star")
    later = rows.join(found, "h", "left_anti").select("key", F.col("h").alias("b"), *side("b", "own"))
    rest = (later.join(rows.select("key", F.col("h").alias("a"), *side("a", "own")), "key")
            .filter((F.col("first_a") < F.col("first_b")) & (F.col("own_a") | F.col("own_b")) & fit)
            .select("a", "b").distinct())
    out = scratch.put(found.union(verified(rest)), f"{name}-near")
    scratch.drop(f"{name}-star")
    return out


def _lines_met(classes: DataFrame, met: DataFrame) -> DataFrame:
    """The classes with keys that others have, too."""
    keys = met.select("h").distinct()
    few = keys.count() <= BROADCAST_KEYS
    return classes.join(F.broadcast(keys) if few else keys, "h", "left_semi")


def near_by_chars(classes: DataFrame, rules: LineRules, scratch: Scratch) -> DataFrame:
    """(h) of the classes within ``threshold`` characters of an earlier one."""
    met = met_rows(char_rows(classes, rules), scratch, "chars-met", indexed=True)
    lines = scratch.put(_lines_met(classes, met).select(
        "h", "first", F.length("line").alias("n"), F.array(_letters(0), _letters(1)).alias("sig"), "line"), "chars-lines")
    out = _near(met, lines, F.lit(rules.threshold), within(F.col("chars_a"), F.col("chars_b"), rules.threshold), scratch, "chars",
                {f"chars_{k}": F.split(f"line_{k}", "") for k in "ab"})
    scratch.drop("chars-met", "chars-lines")
    return out


def near_by_words(classes: DataFrame, rules: LineRules, scratch: Scratch) -> DataFrame:
    """(h) of the classes within :func:`word_edits` words of an earlier one."""
    met = met_rows(word_rows(classes, rules), scratch, "words-met", indexed=True)
    hashed = F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w))
    lines = _lines_met(classes, met).select("h", "first", F.explode(F.array(hashed)).alias("words"))
    lines = lines.select("h", "first", "words", F.explode(F.array(_word_bag(F.col("words")))).alias("bag"))
    lines = scratch.put(lines.select("h", "first", F.size("words").alias("n"), F.array(_letters(0, "bag"), _letters(1, "bag")).alias("sig"),
                                     "words", _code_text(F.col("words")).alias("code")), "words-lines")
    edits = word_edits(F.least("n_a", "n_b"), rules)
    out = _near(met, lines, edits, words_within("a", "b", edits), scratch, "words")
    scratch.drop("words-met", "words-lines")
    return out


def removals(docs: DataFrame, rules: LineRules, scratch: Scratch, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(h, first, near): classes that lose occurrences; ``near`` when an
    earlier class lies within the threshold, so that all occurrences go."""
    classes = scratch.put(classes_of(lines_of(docs, id_col, text_col)), "classes")
    near = (near_by_chars(classes, rules, scratch).union(near_by_words(classes, rules, scratch))
            .distinct().withColumn("near", F.lit(True)))
    out = (classes.select("h", "first", "n").join(near, "h", "left")
           .withColumn("near", F.coalesce("near", F.lit(False))).filter(F.col("near") | (F.col("n") > 1)))
    out = scratch.put(out.select("h", "first", "near"), "removals")
    scratch.drop("classes", "chars-near", "words-near")
    return out


def removed_lines(docs: DataFrame, rules: LineRules, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, gone: array of (line_no, near)) of the documents that lose lines."""
    scratch = Scratch(docs.sparkSession, "lines", _TABLES)
    lost = removals(docs, rules, scratch, id_col, text_col)
    gone = (_keyed(lines_of(docs, id_col, text_col)).select("h", "id", "t", "line_no")
            .join(lost.hint("shuffle_hash"), "h")
            .filter(F.col("near") | ~F.struct("id", "t", "line_no").eqNullSafe(F.col("first"))))
    out = gone.groupBy("id", "t").agg(F.collect_set(F.struct("line_no", "near")).alias("gone"))
    out = scratch.put(out, "gone")
    scratch.drop("removals")
    return out.hint("shuffle_hash")      # grows with the corpus: never broadcast; the texts need no sort


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines whose numbers are in ``gone``."""
    numbers = F.transform(gone, lambda g: g["line_no"])
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(numbers, i))
    return F.when(gone.isNull(), text).otherwise(F.array_join(left, "\n"))


def line_dedup(docs: DataFrame, rules: LineRules, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_lines (not blank), n_exact and n_near (lines removed
    as equal, or as near, to an earlier one), text without them."""
    gone = removed_lines(docs, rules, id_col, text_col).withColumnsRenamed({"id": "gone_id", "t": "gone_t"})
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    j = src.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.xxhash64("text") == F.col("gone_t")), "left")
    count = lambda near: F.coalesce(F.size(F.filter("gone", lambda g: g["near"] == near)), F.lit(0)).cast("long")
    # blank lines aren't counted; a null text has no lines
    n_lines = F.coalesce(F.size(F.filter(F.split("text", "\n"), _has_ink)), F.lit(0)).cast("long")
    return j.select(F.col("id").alias(id_col), n_lines.alias("n_lines"),
                    F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(count(False)).alias("n_exact"),
                    F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(count(True)).alias("n_near"),
                    _without(F.col("text"), F.col("gone")).alias("text"))


def apply(docs: DataFrame, rules: LineRules, id_col: str = "doc_id", text_col: str = "text",
          length_col: str | None = "n_chars") -> DataFrame:
    """The documents, all columns, with those lines removed from the text (and
    its length column brought up to date); a document of which nothing but
    blanks is left goes."""
    gone = removed_lines(docs, rules, id_col, text_col).select(
        F.col("id").alias("__gone_id"), F.col("t").alias("__gone_t"), F.col("gone").alias("__gone"))
    j = docs.join(gone, docs[id_col].eqNullSafe(F.col("__gone_id"))
                  & (F.xxhash64(docs[text_col]) == F.col("__gone_t")), "left")
    j = j.withColumn("__text", _without(docs[text_col], F.col("__gone")))
    j = j.filter(F.col("__gone").isNull() | F.col("__text").rlike("\\S"))
    cols = []
    for c in docs.columns:
        if c == text_col:
            cols.append(F.col("__text").alias(c))
        elif c == length_col and length_col is not None:
            cols.append(F.when(F.col("__gone").isNull(), docs[c])
                        .otherwise(F.length("__text")).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(docs[c])
    return j.select(*cols)
