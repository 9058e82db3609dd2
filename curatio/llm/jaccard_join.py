"""N-gram Jaccard join with size-banded tiles and hashed bitmap signatures.

A document's set is its distinct word shingles (five words; fewer words: the
whole sequence), held as a sorted array of 64-bit hashes. Documents with equal
sets form a class. Two classes link when ``100 * intersection >= 80 * union``.

* Tiles. Linked sets share one of the first ``n - ceil(0.8 n) + 1`` shingles
  in any common order. The order puts frequent shingles last (a bounded list
  of the most frequent, counted over all documents) and is by hash otherwise,
  so a passage that many documents hold hardly ever makes a tile. A tile is a
  shingle and a pair of size bands; a large one is split into blocks, and its
  pairs of blocks are compared apart.
* Signatures. Each set has a bitmap of about twice as many bits as shingles, in
  which every shingle flips one bit. Bits that differ bound the symmetric
  difference from below and so the intersection from above. Pairs that pass
  are verified by exact intersection of the sorted arrays.
* Copies. Each class is first held against the smallest and the largest class
  key of every tile that it is in, which joins large groups of near copies in
  as many pairs as they have members. Tiles whose members are then one
  component need no further pair; of the others a forest of the closest pairs
  of different components is verified first, and then all pairs that pass and
  are still apart. No link between components is lost, and a group of near
  copies is never emitted as all its pairs.

Defined results: null or empty texts have ``n_shingles`` 0 and are their own
component; a null id belongs to the component of its set, named after its
smallest id that isn't null (null if there is none); rows that repeat get
equal results; an empty table gives no rows; extra columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm import textnum as tn
from curatio.llm.components import components
from curatio.llm.scratch import Scratch, cleaned_shuffles
from curatio.operators.util import ship_by_value


@dataclass(frozen=True)
class JoinRules:
    words: int = 5
    percent: int = 80
    frequent: int = 262_144       # most frequent shingles that the order puts last (2 MB broadcast)
    block: int = 512              # members of a block of a tile
    max_bits: int = 65_536
    tile_bits: int = 1024         # of the signatures in tiles
    crowd: int = 2048             # a shingle of so many sets has its ends found apart (told from one set of 64)
    fine_bits: int = 1 << 20      # of the wider signatures that pairs are held against before the sets
    broadcast: int = 200_000      # (id, key) rows that may be broadcast to fetch texts (3 MB)


U, I = np.uint64, np.int64


def _need(n, percent):
    """Smallest overlap of a set of n with any set that it links with."""
    return -(-n * percent // 100)


def shingle_sets(col: pa.Array, hasher: tn.Hasher, words: int):
    """(hashes sorted and distinct by row, row) of a chunk of texts."""
    buf, offsets = tn.as_bytes(col)
    low = tn.lower_ascii(buf)
    start, end, row = tn.runs(low, offsets, tn.NOT_SPACE)
    w = hasher.ranges(low, start, end)
    h, first = tn.windows(w, row, words)
    rows = row[first]
    n = len(offsets) - 1
    count = np.bincount(row, minlength=n)
    begin = np.concatenate([[0], np.cumsum(count)])
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        h = np.concatenate([h, np.array([tn.sequence_hash(w[begin[r]:begin[r + 1]]) for r in few], dtype=U)])
        rows = np.concatenate([rows, few])
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
        h, rows = h[new], rows[new]
    return h, rows


def _set_keys(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row's set (0 where empty)."""
    with np.errstate(over="ignore"):
        mixed = np.concatenate([np.zeros(1, U), np.cumsum(tn._splitmix(h ^ U(0xA0761D6478BD642F)))])
        total = mixed[begin[1:]] - mixed[begin[:-1]]
        size = np.diff(begin)
        key = tn._splitmix(total + size.astype(U) * U(0xE7037ED1A0B428DB))
    return np.where(size > 0, key, U(0)).view(I)


def _bitmap(h: np.ndarray, share: float, max_bits: int) -> bytes:
    """Each shingle flips one of about ``share`` bits a shingle (a power of two)."""
    bits = 128
    while bits < share * len(h) and bits < max_bits:
        bits *= 2
    odd = np.bincount((h % U(bits)).astype(I), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def frequent_shingles(docs: DataFrame, rules: JoinRules) -> np.ndarray:
    """The shingles that most documents hold: counted in every text chunk
    (equal sets once), summed over the corpus where a chunk has three or
    more, and cut to a bounded list for the order of shingles."""
    def count(batches):
        hasher = tn.Hasher()
        for batch in batches:
            for whole in tn.chunks(batch, "text", 4 * tn.CHUNK_BYTES):
                # hashed in smaller parts, which bounds the memory
                sets, keys, sizes = [], [], []
                for part in tn.chunks(whole, "text"):
                    h, rows = shingle_sets(part.column("text"), hasher, rules.words)
                    begin = np.searchsorted(rows, np.arange(part.num_rows + 1))
                    sets.append(h)
                    keys.append(_set_keys(h, begin))
                    sizes.append(np.diff(begin))
                _, one = np.unique(np.concatenate(keys), return_index=True)
                only = np.zeros(whole.num_rows, bool)
                only[one] = True
                value, n = np.unique(np.concatenate(sets)[np.repeat(only, np.concatenate(sizes))], return_counts=True)
                often = n >= 3
                yield pa.RecordBatch.from_arrays([pa.array(value[often].view(I)), pa.array(n[often].astype(I))],
                                                 ["shingle", "n"])

    with cleaned_shuffles(docs.sparkSession):
        often = Scratch(docs.sparkSession, "jaccard").put(
            docs.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
            .withColumn("level", F.floor(8 * F.log2("n")).cast("int")), "frequent")
    # the levels of frequency that fit into the list
    levels, room, cut = often.groupBy("level").count().collect(), rules.frequent, None
    for level, n in sorted(levels, reverse=True):
        room -= n
        if room < 0:
            break
        cut = level
    if cut is None:
        return np.zeros(0, U)
    top = often.filter(F.col("level") >= cut).select("shingle").toPandas()
    return np.sort(top["shingle"].to_numpy(np.int64).view(U))


def sketches(docs: DataFrame, rules: JoinRules, frequent: np.ndarray) -> DataFrame:
    """(id, t, n, h, prefix, bits, tile_bits) of each row (id, t, text); prefix and
    bits stand once for equal sets of a chunk. ``tile_bits`` are the bits folded
    to a bounded width, as they stand once for each shingle of a prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        hasher, common = tn.Hasher(), shared.value
        for batch in batches:
            for part in tn.chunks(batch, "text"):
                h, rows = shingle_sets(part.column("text"), hasher, rules.words)
                begin = np.searchsorted(rows, np.arange(part.num_rows + 1))
                keys, size = _set_keys(h, begin), np.diff(begin)
                late = np.zeros(len(h), bool)
                if len(common) and len(h):
                    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
                    late = common[at] == h
                prefixes, maps, narrow, seen = [], [], [], set()
                for i in range(part.num_rows):
                    if size[i] == 0 or keys[i] in seen:
                        prefixes.append(None)
                        maps.append(None)
                        narrow.append(None)
                        continue
                    seen.add(keys[i])
                    a, b = begin[i], begin[i + 1]
                    own, rank = h[a:b], late[a:b]
                    take = int(size[i] - _need(size[i], rules.percent) + 1)
                    first = np.concatenate([own[~rank][:take], own[rank][:max(0, take - int((~rank).sum()))]])
                    prefixes.append(first.view(I))
                    maps.append(_bitmap(own, 1.5, rules.max_bits))
                    narrow.append(_fold(np.frombuffer(maps[-1], U), rules.tile_bits // 64).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("t"), pa.array(size.astype(I)), pa.array(keys, mask=size == 0),
                     pa.array(prefixes, pa.list_(pa.int64())), pa.array(maps, pa.binary()), pa.array(narrow, pa.binary())],
                    ["id", "t", "n", "h", "prefix", "bits", "tile_bits"])

    return docs.mapInArrow(run, f"id {id_type}, t long, n long, h long, prefix array<long>, bits binary, tile_bits binary")


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def _may_link(nx, ny, differ, percent: int):
    """Can sets of these sizes link, if so many bits differ at least?"""
    most = np.minimum((nx + ny - differ) // 2, np.minimum(nx, ny))
    return 100 * most >= percent * (nx + ny - most)


def _passing(pairs: DataFrame, rules: JoinRules) -> DataFrame:
    """Pairs (a, b, na, nb, bits_a, bits_b) whose signatures leave a link open."""
    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
            ok = np.zeros(batch.num_rows, bool)
            for i in np.flatnonzero(_may_link(na, nb, 0, rules.percent)):
                x, y = (np.frombuffer(batch.column(c)[i].as_py(), U) for c in ("bits_a", "bits_b"))
                width = min(len(x), len(y))
                differ = int(np.bitwise_count(_fold(x, width) ^ _fold(y, width)).sum())
                ok[i] = _may_link(na[i], nb[i], differ, rules.percent)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for k in "ab":
        pairs = pairs.join(classes.select(F.col("h").alias(k), F.col("n").alias(f"n{k}"),
                                          F.col("bits").alias(f"bits_{k}")), k)
    return pairs


def _still_open(pairs: DataFrame, classes: DataFrame, rules: JoinRules, scratch: Scratch, name: str) -> DataFrame:
    """The pairs that signatures of the sets' own widths leave open: those in
    tiles are too narrow to tell long sets apart."""
    needed = scratch.put(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), f"{name}-asked")
    few = needed.count() <= rules.broadcast
    own = classes.join(F.broadcast(needed) if few else needed, "h", "left_semi")
    out = scratch.put(_passing(_with_sketches(pairs, own), rules), f"{name}-open")
    scratch.drop(f"{name}-asked")
    return out


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, rules: JoinRules, scratch: Scratch,
             name: str) -> DataFrame:
    """The pairs (a, b) that link, by exact intersection. The sets of the
    classes that occur in pairs are made anew from one document of each, known
    by its id, which may be null, and the hash of its text."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct().join(reps, "h")
    wanted = scratch.put(wanted.select("h", F.col("doc.id").alias("want_id"), F.col("doc.t").alias("want_t")), f"{name}-wanted")
    few = wanted.count() <= rules.broadcast
    texts = docs.join(F.broadcast(wanted) if few else wanted,
                      (docs["t"] == F.col("want_t")) & docs["id"].eqNullSafe(F.col("want_id")))

    def sets(batches):
        hasher, seen = tn.Hasher(), set()
        for batch in batches:
            for part in tn.chunks(batch, "text"):
                h, rows = shingle_sets(part.column("text"), hasher, rules.words)
                begin = np.searchsorted(rows, np.arange(part.num_rows + 1))
                keys = _set_keys(h, begin)
                # of repeated rows, the first that this task sees
                fits = np.flatnonzero(keys == part.column("h").to_numpy(zero_copy_only=False))
                right = np.array([i for i in fits if keys[i] not in seen and not seen.add(keys[i])], np.int64)
                lists = [h[begin[i]:begin[i + 1]] for i in right]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[right]), pa.array([len(x) for x in lists], pa.int64()),
                     pa.array([_bitmap(x, 12, rules.fine_bits) for x in lists], pa.binary()),
                     pa.array([x.tobytes() for x in lists], pa.binary())], ["h", "n", "bits", "items"])

    # rows that repeat an id give their set again, and equal pairs: harmless
    arrays = scratch.put(texts.select("h", "text").mapInArrow(sets, "h long, n long, bits binary, items binary"),
                         f"{name}-sets")
    pairs = scratch.put(_passing(_with_sketches(pairs, arrays), rules).distinct(), f"{name}-close")
    # the sets themselves move only for the classes of pairs that are left
    needed = scratch.put(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), f"{name}-needed")
    few = needed.count() <= rules.broadcast
    items = arrays.select("h", "items").join(F.broadcast(needed) if few else needed, "h", "left_semi")
    both = (pairs.join(items.select(F.col("h").alias("a"), F.col("items").alias("xa")), "a")
            .join(items.select(F.col("h").alias("b"), F.col("items").alias("xb")), "b"))

    def exact(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"))):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * inter >= rules.percent * (len(x) + len(y) - inter)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    out = scratch.put(both.select("a", "b", "xa", "xb").mapInArrow(exact, "a long, b long").distinct(), f"{name}-links")
    scratch.drop(f"{name}-sets", f"{name}-wanted", f"{name}-close", f"{name}-needed")
    return out


def _spanning(found):
    """Of (differing bits, a, b) pairs a forest that joins what they join,
    with few differing bits."""
    parent: dict = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for _, a, b, ra, rb in sorted(found):
        x, y = top(ra), top(rb)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return out


def _tile_pairs(tiles: DataFrame, rules: JoinRules, forest: bool) -> DataFrame:
    """Pairs (a, b) of a tile's members, of different components and sides,
    whose signatures leave a link open: all, or a forest of the closest that
    joins the same components, and (tile, null) of the tiles that have pairs
    besides. The rows of a tile come together; a tile holds two blocks at most."""
    def run(batches):
        def flush(tile, rows):
            h = np.array([r[0] for r in rows])
            n = np.array([r[1] for r in rows])
            root = np.array([r[2] for r in rows])
            side = np.array([r[3] for r in rows])
            left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
            width = min(len(r[4]) for r in rows) // 8
            bits = np.stack([_fold(np.frombuffer(r[4], U), width) for r in rows])
            found = []
            for i in left:
                js = right[(root[right] != root[i]) & ((side[i] < 0) | (h[right] > h[i]))]
                js = js[_may_link(n[i], n[js], 0, rules.percent)]
                if len(js):
                    differ = np.bitwise_count(bits[js] ^ bits[i]).sum(axis=1).astype(I)
                    ok = _may_link(n[i], n[js], differ, rules.percent)
                    found += [(d, min(h[i], h[j]), max(h[i], h[j]), root[i], root[j])
                              for d, j in zip(differ[ok].tolist(), js[ok])]
            if not forest:
                return [f[1:3] for f in found]
            tree = _spanning(found)
            return tree + [(tile, None)] * (len(tree) < len(found))

        key, rows, out = None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("tile", "h", "n", "root", "side", "bits")]
            for tile, *row in zip(*cols):
                if tile != key:
                    if len(rows) > 1:
                        out += flush(key, rows)
                    key, rows = tile, []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])
                out = []
        if len(rows) > 1:
            out = flush(key, rows)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    dealt = tiles.repartition("tile").sortWithinPartitions("tile")
    return dealt.select("tile", "h", "n", "root", "side", "bits").mapInArrow(run, "a long, b long").distinct()


def _tiles(members: DataFrame, rules: JoinRules) -> DataFrame:
    """Members (tok, h, n, root) dealt to tiles: a shingle, if it has few
    members; else a shingle, a pair of neighbouring size bands, a pair of
    blocks. ``side`` is 0 where a block meets itself, else -1 and 1."""
    step = 100 / rules.percent
    m = members.withColumn("band", F.floor(F.log(F.col("n")) / F.log(F.lit(step)) + 1e-9))
    sizes = m.groupBy("tok", "band").agg(F.count(F.lit(1)).alias("k"))
    large = (sizes.groupBy("tok").agg(F.sum("k").alias("all"), F.map_from_entries(F.collect_list(
        F.struct("band", F.ceil(F.col("k") / rules.block).alias("b")))).alias("bands"))   # a few dozen bands at most
             .filter(F.col("all") > rules.block).select("tok", "bands"))
    m = m.join(large, "tok", "left")
    small = m.filter("bands IS NULL").select(F.xxhash64("tok").alias("tile"), "h", "n", "root", F.lit(0).alias("side"))
    m = m.filter("bands IS NOT NULL").select(
        "tok", "h", "n", "root", "band", F.col("bands")[F.col("band")].alias("blocks"),
        F.try_element_at("bands", F.col("band") + 1).alias("above"),
        F.try_element_at("bands", F.col("band") - 1).alias("below"))
    m = m.withColumn("block", F.pmod("h", F.col("blocks")))
    own = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(
        F.col("band").alias("lo"), F.col("band").alias("hi"), F.least("block", j).alias("x"), F.greatest("block", j).alias("y"),
        F.when(j == F.col("block"), 0).when(F.col("block") < j, -1).otherwise(1).alias("side")))
    up = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce("above", F.lit(1)) - 1), lambda j: F.struct(
        F.col("band").alias("lo"), (F.col("band") + 1).alias("hi"), F.col("block").alias("x"), j.alias("y"),
        F.lit(-1).alias("side")))
    down = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce("below", F.lit(1)) - 1), lambda j: F.struct(
        (F.col("band") - 1).alias("lo"), F.col("band").alias("hi"), j.alias("x"), F.col("block").alias("y"),
        F.lit(1).alias("side")))
    none = F.array_except(own, own)
    spots = F.concat(own, F.when(F.col("above").isNull(), none).otherwise(up),
                     F.when(F.col("below").isNull(), none).otherwise(down))
    split = (m.select("tok", "h", "n", "root", F.explode(spots).alias("s"))
             .select(F.xxhash64("tok", "s.lo", "s.hi", "s.x", "s.y").alias("tile"), "h", "n", "root", "s.side"))
    return small.unionByName(split)


def _with_ends(members: DataFrame, rules: JoinRules, scratch: Scratch) -> DataFrame:
    """(tok, h, lo, hi) of the shingles that several sets hold, with the smallest
    and the largest of them: in one shuffle, but for crowded shingles, whose
    ends are summed up before they are shuffled and told to all tasks."""
    one_of = 64
    crowded = (members.filter(F.pmod("h", F.lit(one_of)) == 0).groupBy("tok").agg(F.count(F.lit(1)).alias("k"))
               .filter(F.col("k") >= rules.crowd // one_of).orderBy(F.desc("k"), "tok").limit(rules.broadcast).select("tok"))
    crowded = F.broadcast(scratch.put(crowded, "crowded"))
    by_tok = Window.partitionBy("tok")
    lone = (members.join(crowded, "tok", "left_anti").withColumn("lo", F.min("h").over(by_tok))
            .withColumn("hi", F.max("h").over(by_tok)).filter("lo <> hi"))
    many = members.join(crowded, "tok", "left_semi")
    ends = many.groupBy("tok").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    return lone.unionByName(many.join(F.broadcast(ends), "tok").filter("lo <> hi"))


def _classified(docs: DataFrame, rules: JoinRules, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, t (hash of the text), n, h (key of its set; null if empty),
    root (that of its component), name (smallest id of the component)."""
    ship_by_value(__name__, "curatio.llm.textnum")
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("t"))
    frequent = frequent_shingles(src.select("text"), rules)
    sk = scratch.put(sketches(src, rules, frequent), "sketches")
    classes = scratch.put(sk.filter("prefix IS NOT NULL").groupBy("h").agg(
        F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"),
        F.first("tile_bits").alias("tile_bits")), "classes")
    ids = scratch.put(sk.select("id", "t", "n", "h"), "ids")
    small = scratch.put(classes.select("h", "n", "bits", "tile_bits"), "signatures")
    reps = scratch.put(ids.filter("h IS NOT NULL").groupBy("h").agg(
        F.min("id").alias("rep"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("doc")), "reps")
    scratch.drop("sketches")
    shared = scratch.put(_with_ends(classes.select("h", F.explode("prefix").alias("tok")), rules, scratch), "shared")
    scratch.drop("classes")
    # every member against the two ends of its tile
    ab = shared.select("h", F.explode(F.array("lo", "hi")).alias("o")).filter("h <> o")
    ab = ab.select(F.least("h", "o").alias("a"), F.greatest("h", "o").alias("b")).distinct()
    ab = scratch.put(_passing(_with_sketches(ab, small), rules), "ends")
    links = verified(ab, src, reps, rules, scratch, "ends")
    # the rest: tiles that still hold more than one component; first a forest
    # of their closest pairs, then, of the tiles with pairs besides, all that
    # are still apart (links only join more)
    def tagged(rows, name):
        roots = components(links, scratch, name)
        return (rows.join(roots.withColumnRenamed("node", "h"), "h", "left")
                .withColumn("root", F.coalesce("root", "h")))

    def close(tiles, forest, name):
        tiles = tiles.join(small.select("h", F.col("tile_bits").alias("bits")), "h")
        return scratch.put(_tile_pairs(tiles, rules, forest), name)

    rows = scratch.put(tagged(shared.select("tok", "h"), "roots-ends"), "tagged")
    scratch.drop("shared")
    mixed = scratch.put(rows.groupBy("tok").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
                        .filter("r0 <> r1").select("tok"), "mixed")
    few = mixed.count() <= rules.broadcast
    kept = scratch.put(rows.join(F.broadcast(mixed) if few else mixed, "tok"), "kept")
    # shingles with the same members make one tile
    one = (kept.groupBy("tok").agg(
        F.count(F.lit(1)).alias("k"), F.bit_xor(F.xxhash64("h")).alias("x"),
        F.bit_xor(F.xxhash64("h", F.lit(1))).alias("y")).groupBy("k", "x", "y").agg(F.min("tok").alias("tok")))
    left = scratch.put(kept.join(one.select("tok"), "tok").join(small.select("h", "n"), "h"), "left")
    scratch.drop("tagged", "mixed", "kept")
    found = close(_tiles(left, rules), True, "forest")
    pairs = _still_open(found.filter("b IS NOT NULL"), small, rules, scratch, "forest")
    links = links.union(verified(pairs, src, reps, rules, scratch, "forest"))
    unsettled = scratch.put(found.filter("b IS NULL").select(F.col("a").alias("tile")), "unsettled")
    few = unsettled.count() <= rules.broadcast
    tiles = _tiles(tagged(left.drop("root"), "roots-forest"), rules).join(
        F.broadcast(unsettled) if few else unsettled, "tile", "left_semi")
    # without the pairs that the forest had and that did not link
    rest = close(tiles, False, "rest").join(found.filter("b IS NOT NULL"), ["a", "b"], "left_anti")
    links = links.union(verified(_still_open(rest, small, rules, scratch, "rest"), src, reps, rules, scratch, "rest"))
    scratch.drop("left", "unsettled", "forest", "rest", "forest-open", "rest-open")
    roots = components(links, scratch, "all")
    named = (reps.join(roots.withColumnRenamed("node", "h"), "h", "left")
             .withColumn("root", F.coalesce("root", "h")))
    names = named.groupBy("root").agg(F.min("rep").alias("name"))
    by_class = scratch.put(named.join(names, "root").select("h", "root", "name"), "names")
    scratch.drop("ends", "signatures", "reps", "crowded")
    return ids.join(by_class, "h", "left")


def jaccard_components(docs: DataFrame, rules: JoinRules | None = None, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id."""
    found = _classified(docs, rules or JoinRules(), id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.when(F.col("h").isNull(), F.col("id")).otherwise(F.col("name")).alias("component_id"))


def one_of_each(docs: DataFrame, rules: JoinRules | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The input rows, all columns, of one document of each component: that of
    the smallest id (null ids last; then by a hash of the text). Texts without
    words stay; of rows that repeat an id and a text one stays."""
    found = _classified(docs, rules or JoinRules(), id_col, text_col).filter("h IS NOT NULL")
    stay = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("doc"))
    stay = stay.select(F.col("doc.id").alias("__id"), F.col("doc.t").alias("__t")).distinct().withColumn("__stay", F.lit(True))
    text = docs[text_col]
    kept = docs.join(stay, docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__t")), "left").filter(
        F.coalesce(F.col("__stay"), F.lit(False)) | text.isNull() | ~text.rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*[docs[c] for c in docs.columns]).dropDuplicates([id_col, text_col])
