"""Near-duplicate detection with b-bit MinHash.

1. Each document's set of word shingles gives ``BANDS x ROWS`` minima under as many hash functions. A band
   key folds ``rows`` whole minima; of each minimum the two low bits are kept, packed in bit planes.
2. Documents with the same set form a class, of which one representative goes on.
3. Representatives that share a band key meet in a bucket. A bucket is compared as a star: one hub with all
   members, never all pairs. The packed planes give an estimate that is corrected for chance matches of
   low bits; pairs well below the threshold end there, others are confirmed on whole sets.
4. Confirmed links are merged into components. A bucket whose members are in one component is settled. Small
   open buckets are compared in pairs of different components. Large ones are dealt out anew, exactly, relative
   to their hub: let x have no link with the hub and a link with y. Then x and y share a shingle that the hub
   lacks; or else y has fewer shingles of its own than it lacks of the hub's, and x and y lack a common one
   (see ``_dealt``). So both meet at such a shingle, in a bucket that holds those alone who differ from the hub
   in the same place. What is still large and open is compared by further hubs, eight times as many each
   round, until every pair of a bucket has been compared or is in one component. So a group of near copies
   costs one star, and no link is lost to a cap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernels
from .components import connected
from .scratch import materialize, unused

MINIMA = 192
SMALL_BUCKET = 48
FIRST_HUBS = 128
#: Standard deviations of the estimate below the threshold at which a pair is still confirmed on whole sets.
SLACK = 5
PLANES = MINIMA // 64

_RNG = np.random.Generator(np.random.PCG64(7))
_XOR = _RNG.integers(0, 2**32, MINIMA, dtype=np.uint32)
_MUL = _RNG.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def band_rows(percent: int) -> int:
    """Most rows a band can have so that a pair at the threshold meets in some band but for one case in a million."""
    for rows in range(12, 1, -1):
        if MINIMA // rows * math.log1p(-((percent / 100) ** rows)) < math.log(1e-6):
            return rows
    return 1


def least_matches(percent: int) -> int:
    """Matching low-bit pairs that a pair at the threshold has but for ``SLACK`` deviations; chance matches are a quarter."""
    p = 0.25 + 0.75 * percent / 100
    return math.floor(MINIMA * p - SLACK * math.sqrt(MINIMA * p * (1 - p)))


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Sorted distinct shingle hashes of each row."""
    for lo, hi, hashes, counts in kernels.word_hashes(column):
        found, sizes = kernels.shingles(hashes, counts, width)
        yield lo, hi, [np.unique(x) for x in np.split(found, np.cumsum(sizes)[:-1])]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _features(sets: list[np.ndarray], rows: int) -> list[np.ndarray]:
    """Set digests, bit planes (documents by 2 * PLANES) and band keys of non-empty sets."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(x) for x in sets[:-1]])
    digest = [np.add.reduceat(kernels.mix(flat ^ np.uint64(salt)), starts) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    x = (flat >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((MINIMA, len(sets)), np.uint32)
    for i in range(MINIMA):
        minima[i] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], starts)
    planes = [np.packbits(((minima >> np.uint32(bit)) & np.uint32(1)).astype(np.uint8), axis=0, bitorder="little").T for bit in (0, 1)]
    planes = np.concatenate([np.ascontiguousarray(p).view("<u8") for p in planes], axis=1)
    keys = np.empty((len(sets), MINIMA // rows), np.uint64)
    for b in range(MINIMA // rows):
        key = np.full(len(sets), b + 1, np.uint64)
        for i in range(b * rows, b * rows + rows):
            key = kernels.mix(key * np.uint64(0x2545F4914F6CDD1D) + minima[i])
        keys[:, b] = key
    return [*digest, planes, keys]


FEATURES = "doc_id long, n_shingles long, set_a long, set_b long, planes array<long>, bands array<long>"


def features(docs: DataFrame, width: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (digest of the set), planes, bands; the last four are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, sets in _sets(batch.column(1), width):
                full = np.array([len(x) > 0 for x in sets])
                columns = [pa.nulls(hi - lo, pa.int64())] * 2 + [pa.nulls(hi - lo, pa.list_(pa.int64()))] * 2
                if full.any():
                    a, b, planes, keys = _features([x for x in sets if len(x)], rows)
                    take = pa.array(np.where(full, np.cumsum(full) - 1, 0), mask=~full)
                    lists = [pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), _signed(x).ravel()) for x in (planes, keys)]
                    columns = [pa.array(_signed(a)).take(take), pa.array(_signed(b)).take(take), *(x.take(take) for x in lists)]
                sizes = pa.array([len(x) for x in sets], pa.int64())
                yield pa.record_batch([ids.slice(lo, hi - lo), sizes, *columns], names=["doc_id", "n_shingles", "set_a", "set_b", "planes", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FEATURES)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """node, planes and shingles (sorted 64-bit hashes, packed) of rows with doc_id, text and planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _sets(batch.column(1), width):
                rest = [batch.column(k).slice(lo, hi - lo) for k in (0, 2)]
                yield pa.record_batch([*rest, pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "planes", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("node"), "text", "planes").mapInArrow(run, "node long, planes array<long>, shingles binary")


def _matches(pa_, pb) -> F.Column:
    """How many of the low-bit pairs of two rows' planes are equal."""
    differ = [F.bit_count(pa_[i].bitwiseXOR(pb[i]).bitwiseOR(pa_[i + PLANES].bitwiseXOR(pb[i + PLANES]))) for i in range(PLANES)]
    return F.lit(MINIMA) - sum(differ)


def _side(sets: DataFrame, node: str, *columns: str) -> DataFrame:
    """``node`` and columns of the sets, as ``node`` and names that end in it."""
    return sets.select(F.col("node").alias(node), *[F.col(c).alias(f"{c}_{node}") for c in columns])


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union; x and y sorted and without repeats."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _numbers(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint64)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those, as a < b, whose low bits leave the threshold within reach and whose whole sets are linked.

    The packed planes go first, so that sets are sent for likely pairs alone. The lesser number, a hub more often
    than not, gets its set in the last join, after which no row moves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_linked(_numbers(x), _numbers(y), percent) for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    likely = ordered.join(_side(sets, "a", "planes"), "a").join(_side(sets, "b", "planes"), "b")
    likely = likely.where(_matches(F.col("planes_a"), F.col("planes_b")) >= least_matches(percent)).select("a", "b")
    whole = likely.join(_side(sets, "b", "shingles"), "b").join(_side(sets, "a", "shingles"), "a")
    return whole.select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long")


def _dealt(own: np.ndarray, hub: np.ndarray, percent: int) -> tuple[bool, list[tuple[np.ndarray, int, int]]]:
    """Whether a member's set is linked with its hub's; and where the member is dealt to: shingles, sign, side.

    Write n for the hub's size, t for percent / 100; for a member x, u(x) for its shingles beyond the hub's and a(x) for
    those of the hub that it lacks; x is outside if it has no link with the hub. Let x be outside and linked with y.

    Beyond (sign 0): x and y have at least t / (1 + t) * (|x| + |y|) shingles in common, with |y| >= t * |x|, and at most
    n - a(x) of these are the hub's. So they share at least r(x) shingles beyond it, and if they share any at all, then
    one of the first u(x) - r(x) + 1 of x (r(x) at least 1) in the order of hashes, which is one of the first ones of y too.

    Lacking (sign 1): if they share none, the link says a(x) + a(y) + t * (u(x) + u(y)) - (1 - t) * n <= (1 + t) * i, where i
    counts what both lack. As x is outside, a(x) + t * u(x) - (1 - t) * n = e(x) > 0. So i > (a(y) + t * u(y)) / (1 + t),
    which i <= a(y) allows only where u(y) < a(y) (y is lean), and i >= e(x) / t. Prefixes as above.

    Side: 1 for one that is outside, 2 for one that such a one may meet, 3 for both.
    """
    beyond, lacking = np.setdiff1d(own, hub, assume_unique=True), np.setdiff1d(hub, own, assume_unique=True)
    n, u, a = len(hub), len(beyond), len(lacking)
    excess = 100 * a + percent * u - (100 - percent) * n  # 100 * e
    outside = excess > 0
    least = -(-len(own) * percent // 100)
    r = -(-(len(own) + least) * percent // (100 + percent)) - (n - a)
    out = [(beyond[: max(0, u - max(r, 1) + 1)], 0, 3 if outside else 2)]
    lean = u < a
    if r < 1 and (outside or lean):
        as_outside = max(1, -(-excess // percent)) if outside else a + 1
        as_lean = (100 * a + percent * u) // (100 + percent) + 1 if lean else a + 1
        out.append((lacking[: max(0, a - min(as_outside, as_lean) + 1)], 1, outside + 2 * lean))
    return not outside, out


STAR = "key long, a long, b long, side int"


def hubs_of(members: DataFrame) -> DataFrame:
    """rep, hub and large (whether the bucket is) of each member of each bucket.

    A small bucket's hub is its least member. A large one's need not be a member, but should be near to most members: each
    member names the least member of its own largest bucket, and of these names the one from the largest bucket counts.
    So buckets of one group of near copies have one hub, most often the text that the copies were made from.
    """
    large = members.where(F.col("n") > SMALL_BUCKET)
    own = large.groupBy("rep").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("center"), F.max("n").alias("size"), F.collect_list("key").alias("keys"))
    named = own.select("rep", "center", "size", F.explode("keys").alias("key"))
    center = named.groupBy("key").agg(F.max_by("center", F.struct("size", -F.col("center"))).alias("hub"))
    far = named.select("key", "rep").join(center, "key").select("rep", "hub", F.lit(True).alias("large"))
    return members.where(F.col("n") <= SMALL_BUCKET).select("rep", "hub", F.lit(False).alias("large")).unionByName(far)


def star(hubs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members with their buckets' hubs (key null; a, b), and rows of large buckets as smaller ones (key, a = member, side).

    A member has at most one hub per band, so that its list of hubs is short. Members of large buckets are
    dealt out in the same pass, which has both sets at hand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(keys, a, b, side):
            return pa.record_batch([pa.array(x, t) for x, t in zip((keys, a, b, side), (pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["key", "a", "b", "side"])

        for batch in batches:
            hubs, reps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            links, found = [], []
            for hub, rep, large, x, y in zip(hubs, reps, batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
                x, y = _numbers(x), _numbers(y)
                if large:
                    linked, parts = _dealt(x, y, percent)
                    for shingles, sign, side in parts:
                        seed = kernels.mix(np.array([(hub * 2 + sign) & (2**64 - 1)], np.uint64))
                        found.append((_signed(kernels.mix(shingles ^ seed)), np.full(len(shingles), rep), np.full(len(shingles), side, np.int32)))
                else:
                    linked = _linked(x, y, percent)
                if linked:
                    links.append((hub, rep))
            yield rows([None] * len(links), [h for h, _ in links], [r for _, r in links], [0] * len(links))
            if found:
                keys, a, side = (np.concatenate(x) for x in zip(*found))
                yield rows(keys, a, a, side)

    lists = hubs.where("rep <> hub").groupBy("rep").agg(F.collect_set(F.struct("hub", "large")).alias("hubs"))
    pairs = lists.join(_side(sets, "rep", "planes", "shingles"), "rep").select("rep", "planes_rep", "shingles_rep", F.inline("hubs"))
    whole = pairs.join(_side(sets, "hub", "planes", "shingles"), "hub")
    whole = whole.where((_matches(F.col("planes_hub"), F.col("planes_rep")) >= least_matches(percent)) | F.col("large"))
    return whole.select("hub", "rep", "large", "shingles_rep", "shingles_hub").mapInArrow(run, STAR)


def _open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of buckets that have members on either side and in more than one component, with component and the bucket's number of rows."""
    now = rows.join(labels, rows.rep == labels.node, "left").withColumn("component", F.coalesce("component", "rep")).drop("node")
    sizes = now.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.bit_or("side").alias("sides"))
    return now.join(sizes.where("lo < hi AND sides = 3").select("key", "n"), "key")


def _small_pairs(rows: DataFrame) -> DataFrame:
    """All pairs of different components and sides in buckets of at most SMALL_BUCKET rows."""
    small = rows.where(F.col("n") <= SMALL_BUCKET)
    x = small.select("key", F.col("rep").alias("a"), F.col("component").alias("ca"), F.col("side").alias("sa"))
    y = small.select("key", F.col("rep").alias("b"), F.col("component").alias("cb"), F.col("side").alias("sb"))
    return x.join(y, "key").where("a < b AND ca <> cb AND (sa | sb) = 3").select("a", "b")


def _same_document(owned: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links between the classes in which rows of one doc_id stand, where their texts differ."""
    own = F.struct("set_a", "set_b")
    spread = owned.groupBy("doc_id").agg(F.min(own).alias("lo"), F.max(own).alias("hi")).where("lo <> hi").select("doc_id")
    spread = materialize(spread, "minhash-spread")
    if spread.isEmpty():
        return None
    placed = materialize(owned.join(spread, "doc_id").join(classes.select("set_a", "set_b", "rep"), ["set_a", "set_b"]).select("doc_id", "rep"), "minhash-placed")
    return placed.join(placed.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Sets are the distinct shingles of ``width`` words; a text of fewer words is one shingle as a whole; a text
    without words has none and is linked with nothing. Documents are linked where 100 * intersection
    >= percent * union; component_id is the smallest doc_id reachable, itself included. Rows that share
    a doc_id count as one document. A null doc_id takes no part: component_id null, kept false. An
    empty table gives no rows; columns other than doc_id and text are ignored.
    """
    rows = band_rows(percent)
    feats = materialize(features(docs, width, rows), "minhash-features")
    owned = feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # planes and bands follow from the set, so that any row of a class has the same
    classes = materialize(
        owned.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.first("planes").alias("planes"), F.first("bands").alias("bands")), "minhash-classes"
    )
    keyed = classes.select("rep", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("hub")).where("n > 1")
    members = materialize(keyed.join(buckets, "key").select("key", "hub", "rep", "n"), "minhash-members")
    wanted = classes.select(F.col("rep").alias("doc_id"), "planes").join(members.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sets = materialize(shingle_sets(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id"), width), "minhash-sets")

    stars = materialize(star(hubs_of(members), sets, percent), "minhash-stars")
    links = stars.where("key IS NULL").select("a", "b")
    same = _same_document(owned, classes)
    labels = connected(links if same is None else links.unionByName(same))
    # every bucket's hub has been compared; of the others, pairs of different components are left
    rest = members.where((F.col("rep") != F.col("hub")) & (F.col("n") <= SMALL_BUCKET) & (F.col("n") > 2)).select("key", "rep", F.lit(3).alias("side"))
    left = rest.unionByName(stars.where("key IS NOT NULL").select("key", F.col("a").alias("rep"), "side"))
    round_, hubs = 0, FIRST_HUBS
    while True:
        open_ = materialize(_open(left, labels), f"minhash-open-{round_}")
        largest = open_.agg(F.max("n")).first()[0]
        if largest is None:
            break
        pairs, crowded = _small_pairs(open_), largest > SMALL_BUCKET
        if crowded:
            large = open_.where(F.col("n") > SMALL_BUCKET)
            # members of both sides first: when they have met all others, those of one side are left, and no pair
            per = large.groupBy("key", "component").agg(F.count("*").alias("c"), F.min(F.struct((-F.col("side")).alias("s"), "rep")).alias("hub"))
            chosen = per.withColumn("r", F.row_number().over(W.partitionBy("key").orderBy("hub.s", "c", "hub"))).where(F.col("r") <= hubs)
            chosen = materialize(chosen.select("key", F.col("hub.rep").alias("hub"), (-F.col("hub.s")).alias("hs"), F.col("component").alias("ch")), f"minhash-hubs-{round_}")
            met = large.join(chosen, "key").where("component <> ch AND (side | hs) = 3").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
            pairs = pairs.unionByName(met)
        more = materialize(confirm(pairs, sets, percent), f"minhash-links-{round_}")
        if not more.isEmpty():
            known = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = connected(known.unionByName(more))
        if not crowded:
            break
        left = materialize(large.join(chosen.select("key", F.col("hub").alias("rep")), ["key", "rep"], "left_anti").select("key", "rep", "side"), f"minhash-left-{round_}")
        round_, hubs = round_ + 1, hubs * 8

    named = classes.select("set_a", "set_b", "rep")
    return (
        feats.select("doc_id", "n_shingles", "set_a", "set_b")
        .join(named, ["set_a", "set_b"], "left")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component; all columns stay, whatever their names.

    The row is one with the component's smallest doc_id; where several rows have that doc_id, the one with the
    least text (null first), so that whole rows that repeat stay once. Rows with a null doc_id all stay. Empty
    texts are components of their own. An empty table gives no rows.
    """
    ids, row, first = unused(docs, "kept_id", "row", "first")
    kept = near_duplicates(docs, width, percent).where("kept").select(F.col("doc_id").alias(ids)).distinct()
    found = docs.join(kept, docs.doc_id == kept[ids], "left_semi").select("doc_id", F.struct(*[docs[c] for c in docs.columns]).alias(row))
    order = F.struct(F.col(row)["text"].isNotNull(), F.col(row)["text"])
    one = found.groupBy("doc_id").agg(F.min_by(row, order).alias(first)).select(f"{first}.*")
    return one.unionByName(docs.where("doc_id IS NULL"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=3, percent=85)
