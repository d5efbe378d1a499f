"""Near-duplicate documents by a grouped prefix join on word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.components import components
from attestry.llm.words import (
    BLANK_CODES, hash_words, mixed, portions, shingle_hashes, text_bytes, word_table,
)
from attestry.session import materialize

PORTION_BYTES = 8 << 20
#: No more shingles than this are ordered by a broadcast list; each holds that part of all shingles.
HOT_PARTS = 1 << 20
HOT_LEAST = 16
LOCAL_LEAST = 4
KEY_BITS = 40
SIGNATURE_WORDS = 8
#: Heads that a group meets per round, and rounds at most; the last comparison is whole anyway.
HEADS, STAR_ROUNDS = 4, 6


def _sets(portion: pa.RecordBatch, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of every text."""
    hashes, lengths = hash_words(text_bytes(portion.column("text")), word_table(BLANK_CODES))
    ends = np.cumsum(lengths)
    return [np.unique(shingle_hashes(hashes[a:b], words)) for a, b in zip(ends - lengths, ends)]


def _class_of(shingles: np.ndarray) -> int:
    """A 64-bit fingerprint of a set: equal for equal sets."""
    total = np.add.reduce(mixed(shingles * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64)
    both = np.array([total ^ np.uint64(len(shingles))], dtype=np.uint64)
    return int(mixed(both * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """Per document (doc_id, text_id, n, class); also rows (key, times) of a portion's frequent shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x, pa.int64()) for x in ("doc_id", "text_id", "n", "class", "key", "times")])
        for portion in portions(batches, "text", PORTION_BYTES):
            sets = _sets(portion, words)
            classes = [_class_of(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    portion.column("doc_id").cast(pa.int64()),
                    portion.column("text_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.nulls(len(sets), pa.int64()),
                    pa.nulls(len(sets), pa.int64()),
                ],
                schema=schema,
            )
            distinct = {c: s for c, s in zip(classes, sets)}
            keys, times = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            often = times >= LOCAL_LEAST
            count = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(count, pa.int64())] * 4
                + [pa.array(keys[often].view(np.int64)), pa.array(times[often].astype(np.int64))],
                schema=schema,
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_id")).mapInArrow(
        run, "doc_id long, text_id long, n long, class long, key long, times long"
    )


def hot_shingles(prints: DataFrame) -> np.ndarray:
    """The most frequent shingles, rarest first; at most ``HOT_PARTS``.

    A shingle is hot if the portions that saw it often saw it in a ``HOT_PARTS``-th of all shingles,
    which no more than ``HOT_PARTS`` can be. It only decides the order of shingles in prefixes,
    which may be any; it leaves the posting lists that one task reads short.
    """
    total = prints.agg(F.sum("n")).first()[0] or 0
    rows = (
        prints.where(F.col("key").isNotNull()).groupBy("key").agg(F.sum("times").alias("times"))
        .where(F.col("times") >= max(HOT_LEAST, total / HOT_PARTS))
        .orderBy("times", "key").select("key").toArrow()
    )
    return rows.column("key").to_numpy().astype(np.int64).view(np.uint64)


def _packed(classes, counts, keys) -> dict[str, bytes]:
    return {
        "classes": np.asarray(classes).astype("<i8").tobytes(),
        "counts": np.asarray(counts).astype("<u4").tobytes(),
        "keys": np.asarray(keys).astype("<u8").tobytes(),
    }


_BLOB = "part int, classes binary, counts binary, keys binary, tops binary"
_BLOB_ARROW = pa.schema([("part", pa.int32()), *[(x, pa.binary()) for x in ("classes", "counts", "keys", "tops")]])


def postings(docs: DataFrame, words: int, hot: np.ndarray, buckets: int, class_parts: int) -> DataFrame:
    """Shingles of every class, packed per portion and hash bucket.

    Parts below ``buckets`` hold, per class, how many shingles fall there and the low bits of each
    (four bytes in ``keys``, the fifth in ``tops``); bucket and low bits name a shingle. Parts from
    ``buckets`` on hold set sizes (``counts``) and, after each other in ``keys``, how many hot
    shingles each class has and their ranks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        by_hash = np.argsort(hot)
        sorted_hot = hot[by_hash]
        for portion in portions(batches, "text", PORTION_BYTES):
            sets = {_class_of(s): s for s in _sets(portion, words) if len(s)}
            if not sets:
                continue
            classes = np.fromiter(sets, dtype=np.int64, count=len(sets))
            sizes = np.array([len(s) for s in sets.values()])
            every = np.concatenate(list(sets.values()))
            owner = np.repeat(np.arange(len(sets)), sizes)
            at = np.minimum(np.searchsorted(sorted_hot, every), max(0, len(hot) - 1))
            is_hot = sorted_hot[at] == every if len(hot) else np.zeros(len(every), dtype=bool)
            rows = {name: [] for name in _BLOB_ARROW.names}

            ranks, hot_owner = by_hash[at[is_hot]] if len(hot) else at[:0], owner[is_hot]
            n_hot = np.bincount(hot_owner, minlength=len(sets))
            to = (classes.view(np.uint64) % np.uint64(class_parts)).astype(np.int64)
            for part in np.unique(to):
                mine = to == part
                blob = _packed(classes[mine], sizes[mine], np.concatenate([n_hot[mine], ranks[mine[hot_owner]]]))
                for name, value in (("part", buckets + int(part)), *blob.items(), ("tops", b"")):
                    rows[name].append(value)

            keys, owner = every[~is_hot], owner[~is_hot]
            bucket = ((keys >> np.uint64(KEY_BITS)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            keys, owner, bucket = keys[order], owner[order], bucket[order]
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            for part in np.flatnonzero(np.diff(bounds)):
                inside = slice(bounds[part], bounds[part + 1])
                heads = np.flatnonzero(np.diff(owner[inside], prepend=-1))
                rows["part"].append(int(part))
                rows["classes"].append(classes[owner[inside][heads]].tobytes())
                rows["counts"].append(np.diff(np.append(heads, len(owner[inside]))).astype("<u4").tobytes())
                rows["keys"].append(keys[inside].astype("<u4").tobytes())
                rows["tops"].append((keys[inside] >> np.uint64(32)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_pydict(rows, schema=_BLOB_ARROW)

    return docs.select("doc_id", "text").mapInArrow(run, _BLOB)


def shared_postings(packed: DataFrame, buckets: int, class_parts: int) -> DataFrame:
    """Shingles of two classes or more, with how many, sent on by class; others end here.

    ``part`` counts class parts; ``tops`` holds a document frequency per entry of ``classes`` and
    ``keys``. Parts with sizes and hot shingles pass through with their tops empty.
    """

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part >= buckets:
            return table.set_column(0, "part", pa.array([part - buckets] * table.num_rows, pa.int32()))
        owners, keys = [], []
        for row in table.to_pylist():
            owners.append(np.repeat(np.frombuffer(row["classes"], "<i8"), np.frombuffer(row["counts"], "<u4")))
            keys.append(
                np.frombuffer(row["keys"], "<u4").astype(np.uint64)
                | (np.frombuffer(row["tops"], np.uint8).astype(np.uint64) << np.uint64(32))
            )
        owners, keys = np.concatenate(owners), np.concatenate(keys)
        order = np.argsort(keys)
        sorted_keys = keys[order]
        same = sorted_keys[1:] == sorted_keys[:-1]
        repeated = np.append(same, False) | np.append(False, same)
        keys, owners = sorted_keys[repeated], owners[order[repeated]]
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
        keys, owners = keys[new], owners[new]
        heads = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
        times = np.diff(np.append(heads, len(keys)))
        df = np.repeat(times, times)
        shared = df > 1
        keys, owners, df = keys[shared] | np.uint64(part << KEY_BITS), owners[shared], df[shared]
        to = (owners.view(np.uint64) % np.uint64(class_parts)).astype(np.int64)
        order = np.lexsort((owners, to))
        bounds = np.searchsorted(to[order], np.arange(class_parts + 1))
        rows = {name: [] for name in _BLOB_ARROW.names}
        for k in np.flatnonzero(np.diff(bounds)):
            mine = order[bounds[k] : bounds[k + 1]]
            rows["part"].append(int(k))
            rows["classes"].append(owners[mine].tobytes())
            rows["counts"].append(b"")
            rows["keys"].append(keys[mine].tobytes())
            rows["tops"].append(df[mine].astype("<u4").tobytes())
        return pa.table(rows, schema=_BLOB_ARROW)

    return packed.groupBy("part").applyInArrow(run, _BLOB)


def _signature(keys: np.ndarray) -> np.ndarray:
    """Parities of hashed keys. Two of them differ in at most as many bits as the sets in keys."""
    slots = (mixed(keys * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(64 * SIGNATURE_WORDS - 1)).astype(np.int64)
    parity = np.bincount(slots, minlength=64 * SIGNATURE_WORDS) & 1
    return np.packbits(parity.astype(bool), bitorder="little").view("<i8")


def linkable_sets(shared: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Classes whose prefix holds a shared shingle: class, n, lone, prefix, keys, signature.

    Shingles are ordered by document frequency, hot ones last. A set of n shingles and a partner
    share one of its first n - ceil(t n) + 1. ``lone`` shingles of the set are in no other set and
    stand first, so a set whose prefix ends among them has no partner. ``prefix`` lists the shared
    shingles of the prefix in order, ``keys`` all shared ones sorted, ``signature`` their parities.
    """
    num, den = share
    schema = pa.schema([
        ("class", pa.int64()), ("n", pa.int64()), ("lone", pa.int64()),
        ("prefix", pa.list_(pa.int64())), ("keys", pa.binary()), ("signature", pa.list_(pa.int64())),
    ])

    def run(table: pa.Table) -> pa.Table:
        heads, owners, keys, ranks = {}, [], [], []
        for row in table.to_pylist():
            classes = np.frombuffer(row["classes"], "<i8")
            values = np.frombuffer(row["keys"], "<u8")
            if row["counts"]:
                n_hot = values[: len(classes)].astype(np.int64)
                ends = np.cumsum(n_hot)
                sizes = np.frombuffer(row["counts"], "<u4")
                for k, name in enumerate(classes.tolist()):
                    if name not in heads:
                        heads[name] = int(sizes[k])
                        hot = values[len(classes) + ends[k] - n_hot[k] : len(classes) + ends[k]]
                        owners.append(np.full(len(hot), name, dtype=np.int64))
                        # Hot ranks lie above every document frequency and every other key.
                        keys.append(hot | np.uint64(1 << 63))
                        ranks.append(hot.astype(np.int64) + (1 << 40))
            else:
                owners.append(classes)
                keys.append(values)
                ranks.append(np.frombuffer(row["tops"], "<u4").astype(np.int64))
        out = {name: [] for name in schema.names}
        if owners:
            owners, keys, ranks = np.concatenate(owners), np.concatenate(keys), np.concatenate(ranks)
            order = np.lexsort((keys, ranks, owners))
            owners, keys = owners[order], keys[order]
            starts = np.flatnonzero(np.diff(owners, prepend=owners[:1] + 1))
            for a, b in zip(starts, np.append(starts[1:], len(owners))):
                n = heads[int(owners[a])]
                lone = n - int(b - a)
                length = n - -(-num * n // den) + 1
                if lone < length:
                    out["class"].append(int(owners[a]))
                    out["n"].append(n)
                    out["lone"].append(lone)
                    out["prefix"].append(keys[a : a + length - lone].view(np.int64))
                    out["keys"].append(np.sort(keys[a:b]).tobytes())
                    out["signature"].append(_signature(keys[a:b]))
        return pa.table(out, schema=schema)

    return shared.groupBy("part").applyInArrow(
        run, "class long, n long, lone long, prefix array<long>, keys binary, signature array<long>"
    )


def _fits(share: tuple[int, int]) -> str:
    """Whether two groups with a common shingle at these places can have enough in common."""
    num, den = share
    return (
        f"{num + den} * least(a.n - a.place, b.n - b.place) >= {num} * (a.n + b.n)"
    )


def _bits_apart(a: str, b: str) -> str:
    """In how many bits two signatures differ."""
    return " + ".join(f"bit_count({a}[{k}] ^ {b}[{k}])" for k in range(SIGNATURE_WORDS))


def _near(share: tuple[int, int]) -> str:
    """Whether some members of two groups can differ in few enough shingles.

    Members stand at most ``radius`` bits from their head's signature, and lone shingles of either
    side are always differences. Sets of m and n shingles that differ in d reach the similarity t
    if and only if (1 - t) (m + n) >= (1 + t) d.
    """
    num, den = share
    apart = _bits_apart("a.signature", "b.signature")
    return f"{den - num} * (a.n + b.n) >= {den + num} * ({apart} - a.radius - b.radius + a.lone + b.lone)"


def verified(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (u, v) of classes that reach the similarity, by their whole sets."""
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            total = np.asarray(batch.column("total"))
            common = np.array(
                [
                    len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), assume_unique=True))
                    for a, b in zip(left, right)
                ],
                dtype=np.int64,
            )
            yield batch.select(["u", "v"]).filter(pa.array(den * common >= num * (total - common)))

    one = sets.select(F.col("class").alias("u"), F.col("n").alias("n_u"), F.col("keys").alias("left"))
    two = sets.select(F.col("class").alias("v"), F.col("n").alias("n_v"), F.col("keys").alias("right"))
    return (
        pairs.join(one, "u").join(two, "v")
        .select("u", "v", (F.col("n_u") + F.col("n_v")).alias("total"), "left", "right")
        .mapInArrow(run, "u long, v long")
    )


def linked_classes(sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``class`` and the least class linked with it, over all sets.

    Sets with the same size, lone count and prefix are one group, since they meet the same
    candidates. First every group's members and, per shingle, every group meet one head, chosen anew
    each round until a round joins nothing: a number of pairs in proportion to the lists. Then all group pairs with a common prefix shingle that fit by
    size, place and signature are expanded to those members that are still in different components;
    pairs inside the largest component of a list are never formed. Nothing is left out: a link between two
    members that are not compared would join what is joined already.
    """
    members = materialize(
        sets.select(
            "class", "n", F.xxhash64("n", "lone", "prefix").alias("g"), "lone", "prefix", "signature"
        )
    )
    groups = members.groupBy("g").agg(
        F.min("class").alias("head"), F.min_by("signature", "class").alias("signature"),
        *[F.any_value(x).alias(x) for x in ("n", "lone", "prefix")],
    )
    shapes = materialize(
        members.select("g", F.col("signature").alias("own")).join(groups.select("g", "lone", "signature"), "g")
        .groupBy("g", "lone", "signature")
        .agg(F.max(F.expr(_bits_apart("own", "signature"))).alias("radius"))
    )
    lists = materialize(
        groups.select("g", "head", "n", "lone", F.posexplode("prefix").alias("pos", "token")).select(
            "token", "g", "head", "n", "lone", (F.col("lone") + F.col("pos")).alias("place")
        )
    )
    joined = members.select("class", "g", F.col("class").alias("component"))
    for round_ in range(STAR_ROUNDS):
        # Sets with few lone shingles stand in the middle of their crowd.
        chance = F.xxhash64("g", F.pmod("token", F.lit(HEADS)), F.lit(round_))
        pick = F.struct(F.col("lone") + F.pmod(chance, F.lit(4 + 4 * round_)), chance)
        heads = lists.groupBy("token").agg(
            F.min_by(F.struct("g", "head", "n", "place"), F.struct(pick, "g")).alias("to")
        ).select("token", "to.*")
        met = (
            lists.alias("a").join(heads.alias("b"), "token").where("a.g <> b.g").where(_fits(share))
            .select(F.col("a.g").alias("g"), F.col("b.head").alias("v")).distinct()
        )
        inside = groups.select("g", F.col("head").alias("v"))
        at_head = joined.select(F.col("class").alias("v"), F.col("component").alias("v_component"))
        pairs = (
            met.unionByName(inside).join(joined, "g").join(at_head, "v")
            .where("component <> v_component").select(F.col("class").alias("u"), "v").distinct()
        )
        links = materialize(verified(pairs, sets, share))
        if links.isEmpty():
            break
        joined = _joined_with(joined, links)

    entries = materialize(
        lists.join(joined, "g").groupBy("token", "g", "component", "n", "place").agg(F.count(F.lit(1)).alias("size"))
    )
    per_part = entries.groupBy("token", "component").agg(F.sum("size").alias("size"))
    open_lists = per_part.groupBy("token").agg(
        F.max_by("component", F.struct("size", "component")).alias("largest"),
        F.count(F.lit(1)).alias("parts"),
    ).where("parts > 1").drop("parts")
    open_entries = materialize(entries.join(open_lists, "token").join(shapes, "g"))
    others = open_entries.where("component <> largest")
    pairs = (
        others.alias("a").join(open_entries.alias("b"), F.col("a.token") == F.col("b.token"))
        .where("a.component <> b.component and (b.component = b.largest or (a.component < b.component))")
        .where(_fits(share)).where(_near(share))
        .select(
            F.col("a.g").alias("g1"), F.col("a.component").alias("c1"),
            F.col("b.g").alias("g2"), F.col("b.component").alias("c2"),
        ).distinct()
    )
    one = joined.select(F.col("g").alias("g1"), F.col("component").alias("c1"), F.col("class").alias("u"))
    two = joined.select(F.col("g").alias("g2"), F.col("component").alias("c2"), F.col("class").alias("v"))
    left = pairs.join(one, ["g1", "c1"]).join(two, ["g2", "c2"]).select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    ).distinct()
    return _joined_with(joined, verified(left, sets, share)).select("class", "component")


def _joined_with(joined: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links between classes."""
    names = joined.select(F.col("class").alias("u"), F.col("component").alias("cu"))
    other = joined.select(F.col("class").alias("v"), F.col("component").alias("cv"))
    between = links.join(names, "u").join(other, "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    merged = components(between).select(F.col("node").alias("component"), F.col("component").alias("into"))
    return materialize(
        joined.join(merged, "component", "left").select(
            "class", "g", F.coalesce("into", "component").alias("component")
        )
    )


def near_duplicates(docs: DataFrame, words: int = 5, share: tuple[int, int] = (75, 100)) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_id, n_shingles, class, component_id.

    A document's set is its distinct runs of ``words`` words (blank-separated, A-Z lower-cased), or
    all its words as one run if it has fewer. Two documents link when intersection / union is at
    least ``share``; component_id is the least doc_id reachable. Documents with equal sets are one
    class and are compared once. Null, empty and blank texts have an empty set, class null, and link
    with nothing. Rows that repeat a doc_id are separate; a null doc_id never names a component of
    others. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    prints = materialize(fingerprints(docs, words))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = postings(docs, words, hot_shingles(prints), parts, parts)
    sets = materialize(linkable_sets(shared_postings(packed, parts, parts), share))
    linked = linked_classes(sets, share)
    rows = prints.where(F.col("n").isNotNull()).select(
        "doc_id", "text_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class")).alias("class")
    )
    per_class = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"))
    named = per_class.join(linked, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("class", "component_id")
    return rows.join(named, "class", "left").select(
        "doc_id", "text_id", "n_shingles", "class",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int = 5, share: tuple[int, int] = (75, 100)) -> DataFrame:
    """The rows of ``docs`` with the least doc_id of every group of linked texts, all columns.

    Texts without words stand alone. Rows with the same doc_id and text are one document; of several
    texts with the least doc_id the one with the least hash stays.
    """
    found = near_duplicates(docs, words, share).groupBy("doc_id", "text_id", "class", "component_id").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    single = F.col("class").isNull() | F.col("component_id").isNull()
    first = F.when(single, F.col("doc_id")).otherwise(F.col("component_id"))
    group = F.struct(first.alias("id"), F.when(single, F.col("text_id")).alias("text"))
    kept = found.groupBy(single.alias("single"), group.alias("group")).agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_id", "_rows")).alias("kept")
    ).select(
        F.col("kept.doc_id").alias("_doc"), F.col("kept.text_id").alias("_text"), F.col("kept._rows").alias("_rows")
    )
    joined = docs.select(F.struct("*").alias("_row")).join(
        kept, F.col("_row.doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("_row.text") == F.col("_text"))
    )
    alone = joined.where("_rows = 1").select("_row.*")
    merged = joined.where("_rows > 1").groupBy("_doc", "_text").agg(F.min("_row").alias("_row")).select("_row.*")
    return alone.unionByName(merged)
