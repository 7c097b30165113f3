"""Exact self-join of shingle sets by Jaccard similarity, and the components of its links.

Equal sets are one class. A class can only have links if three quarters of its shingles (at the
default threshold) occur in other classes too; counting that leaves few. For these, inverted lists
over the rare shingles of each set (a prefix of a common order) hold every linked pair. The lists are
not joined with themselves: each member is compared with its list's head, and what is known of it
from there decides about the others. Members linked with the head have their component; whole blocks
of the rest are skipped by size, by position in the order, or because the overlaps with the head
leave too little room. Of a set that is linked with the head, further overlaps are derived from the
head's by the few shingles in which the two differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import in_small_batches, stored, text_bytes
from tidegauge.llm.components import components, joined_labels
from tidegauge.llm.shingles import WORDS, shingle_sets

#: Similarity from which two documents link, in hundredths.
THRESHOLD = 75
#: Shingles that a task counts at once, and bytes of text whose shingles make a bucket, about.
SHINGLES_AT_ONCE = 1_000_000
BYTES_PER_BUCKET = 8 << 20
#: Slots of the table of counts that orders shingles, rare before frequent.
HEAT_SLOTS = 1 << 18
#: Open pairs of lists are enumerated once they are at most so many times the lists' entries, or
#: after so many more rounds of heads.
OPEN_PAIRS = 1000
HEAD_ROUNDS = 3

_SKETCH = pa.schema([
    ("kind", pa.string()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("mark", pa.int64()),
    ("n", pa.int64()), ("digest", pa.binary()), ("name", pa.int64()), ("chunk", pa.int64()),
    ("names", pa.binary()), ("sizes", pa.binary()), ("prints", pa.binary()),
])
_SKETCH_DDL = (
    "kind string, bucket int, doc_id long, mark long, n long, digest binary, name long, "
    "chunk long, names binary, sizes binary, prints binary"
)
_COUNTED = pa.schema([f for f in _SKETCH if f.name not in ("bucket", "prints")])
_COUNTED_DDL = (
    "kind string, doc_id long, mark long, n long, digest binary, name long, chunk long, names binary, "
    "sizes binary"
)
#: Bytes of a digest that name a set while shingles are counted.
_NAME = 8


def _rows(kind: str, size: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([kind] * size) if f.name == "kind"
        else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
        for f in _SKETCH
    ], schema=_SKETCH)


def _sketch(buckets: int, width: int):
    """Documents with size and digest of their sets; shingles by bucket, with their owners."""

    def chunk_rows(digests: list[bytes], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        chunk = xxhash.xxh3_64_intdigest(b"".join(digests)) >> 1
        names = np.frombuffer(b"".join(d[:_NAME] for d in digests), "<u8")
        shingles = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(shingles, kind="stable")
        shingles, owners = shingles[order], owners[order]
        same = shingles[1:] == shingles[:-1]
        several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        counts = np.bincount(owners[several], minlength=len(sets))
        some = np.flatnonzero(counts)
        if len(some):
            yield _rows(
                "shared", 1, bucket=[chunk % buckets], chunk=[chunk],
                names=[names[some].tobytes()], sizes=[counts[some].astype("<u4").tobytes()],
            )
        # A shingle of several sets of the chunk is counted for them, and told once, without owner.
        first = np.concatenate([[True], ~same])
        shingles, owners = shingles[first], np.where(several[first], len(sets), owners[first])
        home = shingles % np.uint64(buckets)
        prints = ((shingles // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)).astype("<u4")
        order = np.lexsort((owners, home))
        home, prints, owners = home[order], prints[order], owners[order]
        edges = np.searchsorted(home, np.arange(buckets + 1, dtype=np.uint64))
        for b in np.flatnonzero(np.diff(edges)):
            own, sizes = np.unique(owners[edges[b]:edges[b + 1]], return_counts=True)
            yield _rows(
                "shingles", 1, bucket=[b], chunk=[chunk],
                names=[names[own[own < len(sets)]].tobytes()],
                sizes=[sizes.astype("<u4").tobytes()], prints=[prints[edges[b]:edges[b + 1]].tobytes()],
            )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, digests, sets, held = set(), [], [], 0
        for batch in batches:
            found = []
            for shingles in shingle_sets((t.as_py() for t in batch.column(1)), width):
                if not len(shingles):
                    found.append((None, 0))
                    continue
                name = xxhash.xxh3_128_digest(shingles.tobytes())
                found.append((name, len(shingles)))
                if name in seen:
                    continue
                seen.add(name)
                digests.append(name)
                sets.append(shingles)
                held += len(shingles)
                if held >= SHINGLES_AT_ONCE:
                    yield from chunk_rows(digests, sets)
                    seen, digests, sets, held = set(), [], [], 0
            yield _rows(
                "document", len(found), doc_id=batch.column(0), mark=batch.column(2),
                bucket=[(m or 0) % buckets for m in batch.column(2).to_pylist()],
                digest=[d for d, _ in found], n=[n for _, n in found],
                name=[d and int.from_bytes(d[:_NAME], "little", signed=True) for d, _ in found],
            )
        if sets:
            yield from chunk_rows(digests, sets)

    return sketch


def _count(group: pa.Table) -> pa.Table:
    """Of a bucket: the documents as they are; of each chunk, how many shingles of its sets other
    sets have too. Prints that only look equal can make a count too high, never too low."""
    kinds = group["kind"].to_numpy()
    kept = group.filter(pa.array(kinds != "shingles")).select(_COUNTED.names).cast(_COUNTED)
    parts = group.filter(pa.array(kinds == "shingles"))
    if not parts.num_rows:
        return kept
    chunks = parts["chunk"].to_pylist()
    names = [np.frombuffer(x, "<u8") for x in parts["names"].to_pylist()]
    sizes = [np.frombuffer(x, "<u4") for x in parts["sizes"].to_pylist()]
    prints = np.concatenate([np.frombuffer(x, "<u4") for x in parts["prints"].to_pylist()])
    # Sets are numbered over all chunks; what has no owner in its chunk gets a number of its own.
    every, _ = np.unique(np.concatenate(names), return_inverse=True)
    seats, who, at = [], [], 0
    for k, (own, size) in enumerate(zip(names, sizes)):
        numbers = np.searchsorted(every, own)
        if len(size) > len(own):
            numbers = np.append(numbers, -1 - k)
        who.append(np.repeat(numbers, size))
        seats.append(np.repeat(np.append(np.arange(at, at + len(own)), -1)[:len(size)], size))
        at += len(own)
    who, seats = np.concatenate(who), np.concatenate(seats)
    order = np.argsort(prints, kind="stable")
    prints, who, seats = prints[order], who[order], seats[order]
    first = np.concatenate([[True], prints[1:] != prints[:-1]])
    places = np.flatnonzero(first)
    least = np.minimum.reduceat(who, places)
    shared = (least < 0) | (least != np.maximum.reduceat(who, places))
    counted = seats[shared[np.cumsum(first) - 1] & (seats >= 0)]
    counts = np.bincount(counted, minlength=at)
    rows, at = [], 0
    for chunk, own in zip(chunks, names):
        mine = counts[at:at + len(own)]
        at += len(own)
        some = np.flatnonzero(mine)
        if len(some):
            rows.append({
                "kind": "shared", "chunk": chunk, "names": own[some].tobytes(),
                "sizes": mine[some].astype("<u4").tobytes(),
            })
    return pa.concat_tables([kept, pa.Table.from_pylist(rows, schema=_COUNTED)])


def _total(group: pa.Table) -> pa.Table:
    """Shared shingles of the sets of one chunk, over all buckets."""
    names = np.frombuffer(b"".join(group["names"].to_pylist()), "<i8")
    sizes = np.frombuffer(b"".join(group["sizes"].to_pylist()), "<u4")
    every, place = np.unique(names, return_inverse=True)
    return pa.table({
        "name": pa.array(every, pa.int64()),
        "shared": pa.array(np.bincount(place, weights=sizes).astype(np.int64), pa.int64()),
    })


def _sets_of(width: int):
    """The sets themselves, named by digest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sets = [], []
            for shingles in shingle_sets((t.as_py() for t in batch.column(0)), width):
                names.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sets.append(shingles.view(np.int64))
            yield pa.RecordBatch.from_pydict({
                "digest": pa.array(names, pa.binary()), "n": pa.array([len(s) for s in sets], pa.int64()),
                "shingles": pa.array(sets, pa.list_(pa.int64())),
            })

    return work


def _prefixes(heat, threshold: int):
    """The rarest shingles of each set, as many as any linked set must share one of; and the set's
    weight, how frequent its shingles are, by which lists choose their heads: of a group of edited
    copies the least edited one is the nearest to all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = heat.value
        for batch in batches:
            for name, n, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.array(shingles, np.int64).view(np.uint64)
                counts = slots[(own % np.uint64(len(slots))).astype(np.int64)]
                length = n - -(-threshold * n // 100) + 1
                order = np.lexsort((own, counts))[:length]
                yield pa.RecordBatch.from_pydict({
                    "shingle": pa.array(own[order].view(np.int64), pa.int64()),
                    "digest": pa.array([name] * length, pa.binary()),
                    "n": pa.array(np.full(length, n), pa.int64()),
                    "at": pa.array(np.arange(1, length + 1), pa.int64()),
                    "weight": pa.array(np.full(length, counts.mean()), pa.float64()),
                })

    return work


def _can_link(n: str, m: str, overlap: str, threshold: int) -> Column:
    """Whether sets of these sizes link if they share ``overlap``: t (n + m - o) <= 100 o."""
    return F.expr(f"{100 + threshold} * ({overlap}) >= {threshold} * ({n} + {m})")


def verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Overlaps of pairs (``a``, ``b``), counted; of linked ones, in which shingles a differs from b."""
    left = sets.select(F.col("digest").alias("a"), F.col("n").alias("an"), F.col("shingles").alias("as"))
    right = sets.select(F.col("digest").alias("b"), F.col("n").alias("bn"), F.col("shingles").alias("bs"))
    counted = pairs.join(left, "a").join(right, "b").withColumn(
        "overlap", F.size(F.array_intersect("as", "bs")).cast("long")
    )
    linked = _can_link("an", "bn", "overlap", threshold)
    return counted.select(
        "a", "b", "an", "bn", "overlap", linked.alias("linked"),
        F.when(linked, F.array_except("as", "bs")).alias("gained"),
        F.when(linked, F.array_except("bs", "as")).alias("lost"),
    )


def derived(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Overlaps of pairs (``a``, ``b``) from that of a's head with b (``head_overlap``): less the
    head's shingles that a lost and b has, plus those that a gained and b has."""
    right = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("bs"))
    return pairs.join(right, "b").select(
        "a", "b", "an", "bn",
        (F.col("head_overlap") - F.size(F.array_intersect("lost", "bs"))
         + F.size(F.array_intersect("gained", "bs"))).cast("long").alias("overlap"),
    )


def linked_sets(sets: DataFrame, threshold: int) -> DataFrame:
    """``node`` and ``root`` of every set with a link, under all links at or above the threshold."""
    spark = sets.sparkSession
    warm = (
        sets.select(F.explode("shingles").alias("s"))
        .groupBy(F.expr(f"cast((s % {HEAT_SLOTS} + {HEAT_SLOTS}) % {HEAT_SLOTS} AS int)").alias("slot"))
        .count().collect()  # at most HEAT_SLOTS rows
    )
    heat = np.zeros(HEAT_SLOTS, np.int64)
    heat[[r["slot"] for r in warm]] = [r["count"] for r in warm]
    entries = stored(sets.mapInArrow(
        _prefixes(spark.sparkContext.broadcast(heat), threshold),
        "shingle long, digest binary, n long, at long, weight double",
    ), "entries")
    best = F.max(F.struct("weight", "digest", "n", "at"))
    heads = (
        entries.groupBy("shingle").agg(best.alias("head"), F.count("*").alias("size"))
        .where("size > 1")
        .select("shingle", F.col("head.digest").alias("head"), F.col("head.n").alias("head_n"),
                F.col("head.at").alias("head_at"))
    )
    lists = stored(entries.join(heads, "shingle"), "lists")

    def reach(n: str, at: str, m: str, bt: str) -> Column:
        """Two members of a list can link if the shingles from here on suffice."""
        return _can_link(n, m, f"1 + least({n} - {at}, {m} - {bt})", threshold)

    first = lists.where((F.col("digest") != F.col("head")) & reach("n", "at", "head_n", "head_at"))
    answers = stored(verified(
        first.select(F.col("digest").alias("a"), F.col("head").alias("b")).distinct(), sets, threshold
    ), "answers")
    labels = components(answers.where("linked").select("a", "b"), "labels")

    for number in range(HEAD_ROUNDS + 1):
        own = labels.select(F.col("node").alias("digest"), F.col("root").alias("own"))
        labelled = lists.join(own, "digest", "left").withColumn("own", F.coalesce("own", "digest"))
        # Open lists are those of several components: a member is outside if it is not in the
        # head's, and pairs of members inside need no look.
        state = labelled.groupBy("shingle").agg(
            F.max(F.when(F.col("digest") == F.col("head"), F.col("own"))).alias("head_own"),
            F.min("own").alias("least_own"), F.max("own").alias("most_own"),
        ).where("least_own <> most_own").select("shingle", "head_own")
        mixed = stored(
            labelled.join(state, "shingle").withColumn("outside", F.expr("own <> head_own")),
            f"mixed{number}",
        )
        open_lists = mixed.groupBy("shingle").agg(
            F.count(F.when(F.col("outside"), 1)).alias("out"), F.count("*").alias("size"),
            F.max(F.when(F.col("outside"), F.struct("weight", "digest", "n", "at"))).alias("next"),
        )
        if number == HEAD_ROUNDS:
            break
        size, pairs = open_lists.agg(
            F.coalesce(F.sum("size"), F.lit(0)),
            F.coalesce(F.sum(F.col("out").cast("double") * F.col("size")), F.lit(0.0)),
        ).first()
        if not size:
            return labels
        if pairs <= OPEN_PAIRS * size:
            break
        # Too many open pairs: compare all with one more head of each list, taken from outside.
        again = mixed.join(open_lists.select("shingle", "next"), "shingle").where(
            (F.col("digest") != F.col("next.digest")) & reach("n", "at", "next.n", "next.at")
        )
        more = verified(
            again.select(F.col("digest").alias("a"), F.col("next.digest").alias("b")).distinct(), sets, threshold
        ).where("linked")
        labels = joined_labels(labels, more.select("a", "b"), f"more{number}")

    # Overlaps with the head bound those of members with each other.
    known = answers.select(F.col("a").alias("digest"), F.col("b").alias("head"), F.col("overlap").alias("in_head"))
    bounded = mixed.join(known, ["digest", "head"], "left").withColumns({
        "in_head": F.when(F.col("digest") == F.col("head"), F.col("n")).otherwise(F.col("in_head")),
        "block": F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / threshold))).cast("int"),
    })
    outer = bounded.where("outside").select(
        "shingle", F.col("digest").alias("b"), F.col("n").alias("bn"), F.col("at").alias("bt"),
        F.col("own").alias("b_own"), F.col("in_head").alias("b_in"),
        F.explode(F.expr("array(block - 1, block, block + 1)")).alias("block"),
    )
    inner = bounded.select(
        "shingle", "block", F.col("digest").alias("a"), F.col("n").alias("an"), "at",
        F.col("own").alias("a_own"), F.col("in_head").alias("a_in"),
        F.col("outside").alias("a_outside"), F.col("head").alias("a_head"),
    )
    room = "least(coalesce(a_in, an), coalesce(b_in, bn)) + least(an - coalesce(a_in, 0), bn - coalesce(b_in, 0))"
    met = outer.join(inner, ["shingle", "block"]).where(
        F.expr("a_own <> b_own AND a <> a_head AND (NOT a_outside OR a < b)")
        & reach("an", "at", "bn", "bt") & _can_link("an", "bn", room, threshold)
    )
    way = F.when(~F.col("a_outside") & F.col("b_in").isNotNull(), F.struct("a_head", "b_in"))
    pairs = stored(met.groupBy("a", "b").agg(
        F.first("an").alias("an"), F.first("bn").alias("bn"), F.max(way).alias("way")
    ), "pairs")
    changes = answers.where("linked").select("a", F.col("b").alias("head"), "gained", "lost")
    by_way = pairs.select(
        "a", "b", "an", "bn", F.col("way.a_head").alias("head"), F.col("way.b_in").alias("head_overlap")
    ).join(changes, ["a", "head"], "left")
    near = derived(by_way.where("gained IS NOT NULL"), sets).where(_can_link("an", "bn", "overlap", threshold))
    rest = verified(by_way.where("gained IS NULL").select("a", "b"), sets, threshold).where("linked")
    return joined_labels(labels, near.select("a", "b").unionByName(rest.select("a", "b")), "last")


def join(docs: DataFrame, threshold: int = THRESHOLD, width: int = WORDS) -> DataFrame:
    """The component of every document under links of Jaccard similarity at ``threshold`` or more.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id of the component) and
    ``mark``, a hash of id and text.

    A text of fewer than ``width`` words is one shingle, the whole sequence. A null text, or one
    without words, has an empty set and is linked with nothing, not even its like: its component
    is its own id. Rows with a null id take part; they are named null only where no row of the
    component has an id. Repeated rows give equal rows. Texts count whole, whatever their length.
    Other columns are not looked at. An empty table gives no rows.
    """
    return _grouped(docs, threshold, width).drop("root")


def _grouped(docs: DataFrame, threshold: int, width: int) -> DataFrame:
    """What ``join`` returns, and ``root``, the digest that names the component; ids may be null or
    repeated and do not. Of an empty set it is null."""
    rows = in_small_batches(docs).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("mark"),
    )
    size = docs.agg(F.sum(text_bytes(F.col("text")))).first()[0] or 0
    buckets = max(1, -(-size // BYTES_PER_BUCKET))
    counted = stored(
        rows.select("doc_id", "text", "mark").mapInArrow(_sketch(buckets, width), _SKETCH_DDL)
        .groupBy("bucket").applyInArrow(_count, _COUNTED_DDL), "sketch",
    )
    named = counted.where("kind = 'document'").select("doc_id", "mark", "n", "digest", "name")
    classes = named.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.min("mark").alias("mark"), F.first("n").alias("n"),
        F.first("name").alias("name"),
    )
    shared = (
        counted.where("kind = 'shared'").groupBy("chunk").applyInArrow(_total, "name long, shared long")
        .groupBy("name").agg(F.max("shared").alias("shared"))
    )
    alive = stored(
        classes.join(shared, "name").where(f"100 * shared >= {threshold} * n").select("mark", "digest"),
        "alive",
    )
    texts = rows.join(alive.select("mark").distinct(), "mark", "left_semi").select("text")
    sets = stored(
        texts.mapInArrow(_sets_of(width), "digest binary, n long, shingles array<long>")
        .join(alive.select("digest"), "digest", "left_semi")
        .groupBy("digest").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")),
        "sets",
    )
    labels = linked_sets(sets, threshold)
    grouped = classes.select("digest", "first_id").join(
        labels.select(F.col("node").alias("digest"), "root"), "digest", "left"
    ).withColumn("root", F.coalesce("root", "digest"))
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = grouped.join(smallest, "root").select("digest", "root", "component_id")
    return named.drop("name").join(answer, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "mark", "root",
    )


def representatives(docs: DataFrame, threshold: int = THRESHOLD, width: int = WORDS) -> DataFrame:
    """The documents, one of each component: the row of the smallest id (of rows that repeat it, the
    one of the smallest hash, all its copies folded to one). Empty texts all stay."""
    mine = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = _grouped(docs, threshold, width)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark"))
    kept = stored(
        found.where("n_shingles > 0").groupBy("root", "mark")
        .agg(least.alias("one"), F.count("*").alias("copies"))
        .groupBy("root").agg(F.min(F.struct("one", "copies")).alias("kept"))
        .select(F.col("kept.one.mark").alias("kept_mark"), F.col("kept.copies").alias("copies"))
        .unionByName(found.where("n_shingles = 0").select(
            F.col("mark").alias("kept_mark"), F.lit(0).cast("long").alias("copies")).distinct()),
        "kept",
    )
    keyed = docs.select(F.struct("*").alias("doc"), mine.alias("kept_mark"))
    single = keyed.join(kept.where("copies < 2"), "kept_mark", "left_semi")
    folded = keyed.join(kept.where("copies > 1"), "kept_mark", "left_semi").groupBy("kept_mark").agg(
        F.first("doc").alias("doc")
    )
    return single.select("doc.*").unionByName(folded.select("doc.*"))
