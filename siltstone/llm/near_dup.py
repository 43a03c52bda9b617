"""Near-duplicate documents by HyperMinHash (operator 2).

A document is its set of word shingles, held as 64-bit hashes. Its signature has
``REGISTERS`` buckets; a shingle falls into one of them, and the bucket keeps, of its
least hash, the count of leading zeros and ten mantissa bits in 16 bits. Three registers
make a band, and documents that agree in a band are candidates.

1. Documents of equal sets form a class with one signature.
2. In every band bucket each class is compared with the two members that meet most
   others. The collision-corrected estimate of the registers rules pairs out with five
   standard deviations to spare; the rest is decided on the full sets.
3. Links give components. In a bucket of several components, the members outside its
   largest one are compared with all members of other components, in blocks of bounded
   size: first by registers, as in 2., which leaves the members that may have a link; then
   these on the full sets. So no candidate pair is left open.

A pair of similarity 0.8 shares no band with a chance of about 3e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.bytesets import SPACED, Words, blocks, mixed, texts_of
from siltstone.llm.components import components
from siltstone.llm.names import spare_prefix
from siltstone.session import scratch_path

REGISTERS = 72
BAND = 3
MANTISSA = 10
#: Members of a bucket that all others are compared with.
PIVOTS = 2
#: Shingles, and sets, in a block of the exhaustive comparison.
BLOCK_SHINGLES = 200_000
BLOCK_SETS = 2000
_U = np.uint64
_ODDS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


class Sets(NamedTuple):
    """Distinct shingles of a block of texts, text after text, sorted within each."""

    hashes: np.ndarray
    of: np.ndarray
    first: np.ndarray


def shingle_sets(texts: list[bytes], shingle: int) -> Sets:
    """Shingles of ``shingle`` words; a shorter text that has words is one shingle."""
    words = Words(texts, SPACED)
    count = np.diff(words.first)
    width = np.minimum(count, shingle)
    number = np.where(count > 0, count - width + 1, 0)
    of = np.repeat(np.arange(len(texts)), number)
    start = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number) + words.first[of]
    full = np.zeros(len(of), np.uint64)
    reach = width[of]
    for j in range(shingle):
        inside = reach > j
        full[inside] += words.keys[start[inside] + j] * _ODDS[j]
    full = mixed(full + reach.astype(np.uint64))
    order = np.lexsort((full, of))
    full, of = full[order], of[order]
    new = np.ones(len(of), bool)
    new[1:] = (full[1:] != full[:-1]) | (of[1:] != of[:-1])
    full, of = full[new], of[new]
    return Sets(full, of, np.searchsorted(of, np.arange(len(texts) + 1)))


def registers(sets: Sets, texts: int) -> np.ndarray:
    """Leading-zero count plus one above the mantissa bits, per text and bucket; 0 is empty."""
    bucket = ((sets.hashes >> _U(32)) * _U(REGISTERS) >> _U(32)).astype(np.int64)
    value = mixed(sets.hashes ^ _U(0x5851F42D4C957F2D))
    cell = sets.of * REGISTERS + bucket
    order = np.lexsort((value, cell))
    cell, value = cell[order], value[order]
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    cell, least = cell[new], value[new] | _U(1)
    zeros = np.zeros(len(least), np.uint64)
    top = least.copy()
    for step in (32, 16, 8, 4, 2, 1):
        low = top < (_U(1) << _U(64 - step))
        zeros[low] += _U(step)
        top[low] <<= _U(step)
    mantissa = (top << _U(1)) >> _U(64 - MANTISSA)
    out = np.zeros(texts * REGISTERS, np.uint16)
    out[cell] = ((zeros + _U(1)) << _U(MANTISSA) | mantissa).astype(np.uint16)
    return out.reshape(texts, REGISTERS)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple:
    """Similarity of paired signatures, corrected for chance agreement, and its deviation."""
    used = np.maximum(((a > 0) | (b > 0)).sum(axis=1), 1)
    agree = ((a == b) & (a > 0)).sum(axis=1) / used
    return _corrected(agree, used, n, m)


def _corrected(agree: np.ndarray, used: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple:
    ratio = np.minimum(n, m) / np.maximum(np.maximum(n, m), 1)
    chance = 6 * 0.169919487159739094 * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    j = np.clip((agree - chance) / (1 - chance), 0, 1)
    return j, np.sqrt(np.maximum(j * (1 - j), 0.16) / used)


def likely(j: np.ndarray, deviation: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs that the estimate, with five deviations to spare, and the sizes do not rule out."""
    return (j + 5 * deviation >= threshold) & (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


_SIGNED = "rid bigint, doc_id bigint, text_key bigint, n bigint, d1 bigint, d2 bigint, sig binary"


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """Signature and set digest of every row of ``rid, doc_id, text_key, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(3))
            for a, b in blocks(texts):
                sets = shingle_sets(texts[a:b], shingle)
                sig = registers(sets, b - a)
                keys = [batch.column(i).slice(a, b - a) for i in range(3)]
                columns = [
                    pa.array(np.diff(sets.first)),
                    pa.array(_sums(sets.hashes, sets.first)),
                    pa.array(_sums(mixed(sets.hashes * _ODDS[-1]), sets.first)),
                    pa.array([row.tobytes() for row in sig], pa.binary()),
                ]
                names = ["rid", "doc_id", "text_key", "n", "d1", "d2", "sig"]
                yield pa.RecordBatch.from_arrays(keys + columns, names)

    return docs.mapInArrow(run, _SIGNED)


def _full_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``cid, n, set`` of rows ``cid, n, d1, d2, text`` whose text has that digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids, texts = batch.column(0).to_pylist(), texts_of(batch.column(4))
            want = np.array([batch.column(i).to_pylist() for i in (2, 3)], np.int64)
            for a, b in blocks(texts):
                sets = shingle_sets(texts[a:b], shingle)
                one = _sums(sets.hashes, sets.first) == want[0, a:b]
                two = _sums(mixed(sets.hashes * _ODDS[-1]), sets.first) == want[1, a:b]
                rows = np.flatnonzero(one & two)
                made = [sets.hashes[sets.first[i] : sets.first[i + 1]] for i in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cids[a + i] for i in rows], pa.int64()),
                        pa.array([len(s) for s in made], pa.int64()),
                        pa.array([s.tobytes() for s in made], pa.binary()),
                    ],
                    ["cid", "n", "set"],
                )

    sets = docs.select("cid", "n", "d1", "d2", "text").mapInArrow(
        run, "cid bigint, n bigint, set binary"
    )
    return sets.dropDuplicates(["cid"])


def _bands(classes: DataFrame) -> DataFrame:
    """``key, cid`` for each band in which a class has any register."""
    width = 2 * BAND
    band = F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1))).alias("band")
    at = F.col("band") * width + 1
    part = F.substring("sig", at, F.lit(width)).alias("part")
    cut = classes.select("cid", "sig", band).select("cid", "band", part)
    some = F.col("part") != F.lit(bytes(width))
    return cut.filter(some).select(F.xxhash64("band", "part").alias("key"), "cid")


def _shared(classes: DataFrame) -> DataFrame:
    """``key, cid, size`` of the buckets that hold more than one class."""
    bands = _bands(classes)
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    return bands.join(sizes, "key")


def _pivot_pairs(shared: DataFrame) -> DataFrame:
    """Each bucket's members paired with the members that meet most others."""
    met = shared.groupBy("cid").agg(F.sum("size").alias("met"))
    ranked = shared.join(met, "cid")
    first = Window.partitionBy("key").orderBy(F.desc("met"), "cid")
    pivots = ranked.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= PIVOTS)
    pairs = shared.select("key", "cid").join(
        pivots.select("key", F.col("cid").alias("pivot")), "key"
    )
    a, b = F.least("cid", "pivot"), F.greatest("cid", "pivot")
    return pairs.filter("cid <> pivot").select(a.alias("a"), b.alias("b")).distinct()


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose estimate is less than five deviations below the threshold."""
    sides = pairs
    for side in ("a", "b"):
        own = classes.select(F.col("cid").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n", "sig")))
        sides = sides.join(own, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (np.asarray(batch.column(i).to_pylist(), float) for i in (2, 4))
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                for i in (3, 5)
            )
            j, deviation = estimate(left, right, n, m)
            kept = pa.array(likely(j, deviation, n, m, threshold))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(kept) for i in range(2)], ["a", "b"]
            )

    return sides.select("a", "b", "n_a", "sig_a", "n_b", "sig_b").mapInArrow(
        run, "a bigint, b bigint"
    )


def _linked(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Pairs with 100 * intersection >= per_cent * union of the full sets."""
    sides = pairs
    for side in ("a", "b"):
        own = sets.select(F.col("cid").alias(side), F.col("set").alias(f"set_{side}"))
        sides = sides.join(own, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(100 * both >= per_cent * (len(x) + len(y) - both))
            kept = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(kept) for i in range(2)], ["a", "b"]
            )

    return sides.select("a", "b", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    a, b = np.concatenate(left), np.concatenate(right)
    row_a = np.repeat(np.arange(len(left)), [len(s) for s in left])
    row_b = np.repeat(np.arange(len(right)), [len(s) for s in right])
    shared = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(shared):
        return out
    for begin in range(0, len(shared), 4096):
        part = shared[begin : begin + 4096]
        held = []
        for values, rows, number in ((a, row_a, len(left)), (b, row_b, len(right))):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            own = part[at] == values
            dense = np.zeros((number, len(part)), np.float32)
            dense[rows[own], at[own]] = 1
            held.append(dense)
        out += held[0] @ held[1].T
    return out


def _block_links(per_cent: int):
    """Links between two blocks of one bucket that join components not joined yet."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple[int, int]] = []
        if len(left) and len(right):
            right = right.rename(columns=lambda c: c.removeprefix("right_"))
            sets = [[np.frombuffer(s, np.uint64) for s in side["set"]] for side in (left, right)]
            both = _common(*sets)
            n, m = (np.array([len(s) for s in side], np.float32) for side in sets)
            near = 100 * both >= per_cent * (n[:, None] + m[None, :] - both)
            near &= left["comp"].to_numpy()[:, None] != right["comp"].to_numpy()[None, :]
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while x in parent:
                    x = parent[x]
                return x

            lc, rc = left["comp"].tolist(), right["comp"].tolist()
            lid, rid = left["cid"].tolist(), right["cid"].tolist()
            for i, j in np.argwhere(near).tolist():
                x, y = root(lc[i]), root(rc[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    rows.append((lid[i], rid[j]))
        return pd.DataFrame(rows, columns=["a", "b"])

    return run


def _open_buckets(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of buckets of several components: ``key, cid, comp, minor``.

    Buckets of at most ``PIVOTS + 1`` members are settled: all their pairs were compared.
    """
    named = shared.filter(F.col("size") > PIVOTS + 1).join(
        comps.select(F.col("node").alias("cid"), F.col("component").alias("comp")), "cid", "left"
    )
    named = named.select("key", "cid", F.coalesce("comp", "cid").alias("comp"))
    per_comp = named.groupBy("key", "comp").agg(F.count("*").alias("held"))
    tops = per_comp.groupBy("key").agg(
        F.count("*").alias("comps"), F.max(F.struct("held", "comp")).alias("top")
    )
    tops = tops.filter("comps > 1").select("key", F.col("top.comp").alias("top"))
    return named.join(tops, "key").select("key", "cid", "comp", (F.col("comp") != F.col("top")).alias("minor"))


def _likely_members(threshold: float):
    """Members of two blocks of one bucket that may be alike across components, by registers."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found: list[np.ndarray] = []
        if len(left) and len(right):
            right = right.rename(columns=lambda c: c.removeprefix("right_"))
            a, b = (np.frombuffer(b"".join(side["sig"]), np.uint16).reshape(-1, REGISTERS) for side in (left, right))
            n, m = (side["n"].to_numpy(float) for side in (left, right))
            one, two = (side["comp"].to_numpy() for side in (left, right))
            blank = (b == 0).astype(np.float32)
            some = np.zeros(len(right), bool)
            step = max(1, 4_000_000 // (len(right) * REGISTERS))
            for i in range(0, len(left), step):
                own = a[i : i + step]
                used = np.maximum(REGISTERS - (own == 0).astype(np.float32) @ blank.T, 1)
                same = (own[:, None, :] == b[None]) & (own[:, None, :] > 0)
                j, deviation = _corrected(same.sum(axis=2) / used, used, n[i : i + step, None], m[None])
                near = likely(j, deviation, n[i : i + step, None], m[None], threshold)
                near &= one[i : i + step, None] != two[None]
                found.append(left["cid"].to_numpy()[i : i + step][near.any(axis=1)])
                some |= near.any(axis=0)
            found.append(right["cid"].to_numpy()[some])
        cids = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return pd.DataFrame({"cid": cids})

    return run


def _by_blocks(full: DataFrame, columns: list[str], wide, deep) -> tuple[DataFrame, DataFrame]:
    """Minor members and all members of each bucket, dealt to blocks that meet each other once."""
    parts = full.groupBy("key").agg(wide.alias("wide"), deep.alias("deep")).filter("deep > 0")
    full = full.join(parts, "key")
    own = lambda blocks: F.pmod(F.xxhash64("cid"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    left = full.filter("minor").select("key", own("deep").alias("i"), every("wide").alias("j"), *columns)
    right = full.select("key", every("deep").alias("i"), own("wide").alias("j"), *columns)
    # both sides come from one frame: fresh names tell their columns apart
    right = right.toDF(*(f"right_{c}" for c in right.columns))
    return left.groupBy("key", "i", "j"), right.groupBy("right_key", "right_i", "right_j")


def _number(rows, sets: int):
    return F.ceil(rows / sets).cast("int")


def _undecided(members: DataFrame, classes: DataFrame, per_cent: int) -> DataFrame:
    """The members that the registers do not rule out, with their buckets."""
    full = members.join(classes.select("cid", "n", "sig"), "cid")
    minor = F.sum(F.col("minor").cast("int"))
    left, right = _by_blocks(
        full, ["cid", "comp", "n", "sig"], _number(F.count("*"), BLOCK_SETS), _number(minor, BLOCK_SETS)
    )
    found = left.cogroup(right).applyInPandas(_likely_members(per_cent / 100), "cid bigint")
    return members.join(found.distinct(), "cid")


def _exhaustive(members: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Compare each bucket's minor members with all members of other components, by blocks."""
    full = members.join(sets, "cid")
    own = F.col("minor").cast("int")
    wide = F.greatest(_number(F.sum("n"), BLOCK_SHINGLES), _number(F.count("*"), BLOCK_SETS))
    deep = F.greatest(_number(F.sum(own * F.col("n")), BLOCK_SHINGLES), _number(F.sum(own), BLOCK_SETS))
    left, right = _by_blocks(full, ["cid", "comp", "set"], wide, deep)
    return left.cogroup(right).applyInPandas(_block_links(per_cent), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    per_cent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Components of documents linked by similar shingle sets.

    Returns per row ``doc_id, n_shingles, component_id, kept, text_key`` (a hash of the
    text). Rows are linked when 100 * intersection >= ``per_cent`` * union; a component is
    named by its least id, and exactly one row of it is kept: that of the least id, of
    repeated rows the one met first, one without an id only if there is no other. Texts
    that are null, empty or without words are linked with nothing and kept. Other columns
    are ignored; no rows give no rows. Ids are integers.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "near")

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = source.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64("text").alias("text_key"), "text"
    )
    signed = keep(signatures(rows, shingle), "signed")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("head")
    classes = signed.filter("n > 0").groupBy("n", "d1", "d2").agg(head, F.count("*").alias("copies"))
    classes = classes.select("n", "d1", "d2", "copies", F.col("head.doc_id").alias("doc_id"), F.col("head.rid").alias("cid"))
    classes = keep(
        classes.join(signed.select(F.col("rid").alias("cid"), "text_key", "sig"), "cid"), "classes"
    )
    shared = keep(_shared(classes), "shared")
    pairs = keep(_likely(_pivot_pairs(shared), classes, per_cent / 100), "pairs")

    # full sets are needed of paired classes and of members of buckets that may stay open
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b"))
    wanted = wanted.union(shared.filter(F.col("size") > PIVOTS + 1).select("cid")).distinct()
    wanted = classes.join(wanted, "cid", "left_semi").select("cid", "n", "d1", "d2", "doc_id", "text_key")
    texts = source.withColumn("text_key", F.xxhash64("text"))
    same = (texts["text_key"] == wanted["text_key"]) & texts["doc_id"].eqNullSafe(wanted["doc_id"])
    texts = texts.join(wanted, same).select("cid", "n", "d1", "d2", "text")
    sets = keep(_full_sets(texts, shingle), "sets")

    links = keep(_linked(pairs, sets, per_cent), "links")
    comps = components(links)
    members = keep(_open_buckets(shared, comps), "open")
    if not members.isEmpty():
        members = keep(_undecided(members, classes, per_cent), "undecided")
        more = keep(_exhaustive(members, sets, per_cent), "more")
        comps = components(links.union(more))
    return _result(signed, classes, comps)


def _result(signed: DataFrame, classes: DataFrame, comps: DataFrame) -> DataFrame:
    named = classes.join(comps.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.filter("copies > 1 OR component IS NOT NULL").select(
        "n", "d1", "d2", "cid", "doc_id", F.coalesce("component", "cid").alias("component")
    )
    head = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "cid")).alias("head")
    heads = named.groupBy("component").agg(head)
    named = named.join(heads, "component").select(
        "n", "d1", "d2", F.lit(True).alias("grouped"), F.col("head.doc_id").alias("least"), F.col("head.cid").alias("keeper")
    )
    out = signed.join(named, ["n", "d1", "d2"], "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("grouped"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("grouped"), F.col("rid") == F.col("keeper")).otherwise(True).alias("kept"),
        "text_key",
    )


def one_per_group(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with their columns.

    Rows are matched by id and text hash; of rows equal in both, one stays.
    """
    own = spare_prefix(docs)
    kept = found.filter("kept").select(
        F.col("doc_id").alias(f"{own}kept_id"), F.col("text_key").alias(f"{own}kept_key")
    )
    keyed = docs.withColumn(f"{own}key", F.xxhash64(text_col))
    same_id = F.col(id_col).cast("bigint").eqNullSafe(F.col(f"{own}kept_id"))
    same = (F.col(f"{own}key") == F.col(f"{own}kept_key")) & same_id
    held = keyed.join(kept.distinct(), same, "left_semi")
    first = Window.partitionBy(id_col, f"{own}key").orderBy(F.lit(0))
    ranked = held.withColumn(f"{own}nth", F.row_number().over(first))
    # texts without words are linked with nothing: all of them stay
    wordless = ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return ranked.filter((F.col(f"{own}nth") == 1) | wordless).select(docs.columns)
