"""Near-duplicate documents: a multi-index Hamming join over b-bit MinHash signatures.

A document's set is its distinct word shingles; documents are linked if their sets overlap by
``PERCENT`` or more (intersection against union). Signatures have ``SYMBOLS`` MinHash values of 16 bits;
of two linked documents at most every fifth value differs on average. Two signatures that differ in
at most ``RADIUS`` values must, by pigeonhole, differ in at most one value in one of the ``CHUNKS``
chunks; so each chunk is indexed once for each of its values left out, and all pairs under the
signature distance meet. A 128-bit digest of the
signature goes along and rules out most of the pairs that meet by chance. A link at the threshold is
beyond either radius with probability below 2e-5.
Links are confirmed on the full sets.

Groups of copies do not become all pairs:

- Documents with equal sets are one representative from the start.
- In each bucket the members are first tried against one hub; then, where they are not connected
  yet, against other hubs, as long as that finds links. Then the documents of
  buckets with several components are tried against those of other components, all of them but the
  pairs that cannot be links because they share none of their rarest shingles, or because the parities of
  their sets differ too much (exact bounds).
- Components are found by spreading the least label along links, with tables written in between.

Buckets are read as sorted runs, one row at a time. Signatures and sets move only for candidates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import LOWER, UPPER, TwoAges
from layerline.operators.scale import fits_broadcast, materialize, scratch_dir

WORDS = 2
PERCENT = 80
SYMBOLS = 128
CHUNKS = 24
#: Chunks times two, less one: one chunk has at most one error.
RADIUS = 2 * CHUNKS - 1
#: Each of the lowest bits of 128 symbols differs with probability 0.1 at most in a linked pair; more
#: than DIGEST_RADIUS of them with less than 1e-5.
DIGEST_RADIUS = 30
#: Rounds in which bucket members meet one hub: the first ones with few hubs over all buckets, later
#: ones with another hub in each, of which a document tries HUBS_A_ROUND at a time. They end when less
#: than LEAST_YIELD of the tried pairs are links; all other pairs follow then.
FEW_HUBS = 3
HUB_ROUNDS = 10
HUBS_A_ROUND = 8
LEAST_YIELD = 0.05
#: Cells in which shingles of the remaining documents are counted.
RARE_BITS = 20
#: Words of 64 bits in which the parities of a set are kept.
PARITY_WORDS = 8
WORD_CACHE = 300_000
SHINGLES_AT_ONCE = 256

FOLD = str.maketrans(UPPER, LOWER)
SPLIT = re.compile("[ \t-\r]+")


def shingler(words: int):
    """A function from texts to sorted distinct 64-bit shingle hashes."""
    import numpy as np
    import xxhash

    known = TwoAges(WORD_CACHE)
    factor = np.uint64(0x9E3779B97F4A7C15)

    def hashed(word: str) -> int:
        value = known.young.get(word)
        if value is None:
            value = xxhash.xxh64_intdigest(word.encode("utf-8"))
            known.add(word, value)
        return value

    def of(text: str | None):
        found = [hashed(w) for w in SPLIT.split((text or "").translate(FOLD)) if w]
        if not found:
            return np.empty(0, np.uint64)
        values = np.array(found, np.uint64)
        width = min(words, len(values))
        n = len(values) - width + 1
        mixed = np.full(n, width, np.uint64)  # a short text is one sequence, of its own length
        for i in range(width):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * factor + values[i : i + n]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * factor
        return np.unique(mixed ^ (mixed >> np.uint64(29)))

    return of


def signer(symbols: int):
    """A function from shingle hashes to a signature of 16-bit MinHash symbols."""
    import numpy as np

    random = np.random.default_rng(20240607)
    odd = random.integers(0, 1 << 31, symbols, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    last = np.uint32(0x9E3779B1)

    def of(shingles):
        # Shingles are well mixed already; a product with an odd number permutes 32 bits of them.
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(symbols, np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(short), SHINGLES_AT_ONCE):
            np.minimum(least, (short[at : at + SHINGLES_AT_ONCE, None] * odd).min(axis=0), out=least)
        least ^= least >> np.uint32(15)
        return ((least * last) >> np.uint32(16)).astype("<u2")

    return of


def chunk_edges(symbols: int, chunks: int) -> list[int]:
    return [symbols * i // chunks for i in range(chunks + 1)]


def _signatures(rows: DataFrame, words: int, symbols: int) -> DataFrame:
    """_key, _th, n, rid (hash of the set, null for an empty one), sig."""
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingles, signature = shingler(words), signer(symbols)
        for batch in batches:
            sizes, ids, signs = [], [], []
            for body in batch.column(2):
                own = shingles(body.as_py())
                sizes.append(len(own))
                empty = not len(own)
                ids.append(None if empty else xxhash.xxh3_64_intdigest(own.tobytes()) >> 1)
                signs.append(None if empty else signature(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), pa.array(signs, pa.binary())],
                ["_key", "_th", "n", "rid", "sig"],
            )

    return rows.mapInArrow(run, f"_key {kind}, _th long, n long, rid long, sig binary")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """rid, shingles of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = shingler(words)
        for batch in batches:
            found = [shingles(body.as_py()).tobytes() for body in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["rid", "shingles"]
            )

    return rows.select("rid", "_text").mapInArrow(run, "rid long, shingles binary")


def _digest(signs):
    """The lowest bits of the symbols of each signature, as bytes of 128 bits or as many as there are."""
    import numpy as np

    packed = np.packbits((signs & 1).astype(np.uint8), axis=1)
    wide = np.zeros((len(packed), 16), np.uint8)
    wide[:, : packed.shape[1]] = packed[:, :16]
    return wide.view("<i8")


def _index(representatives: DataFrame, symbols: int, chunks: int) -> DataFrame:
    """key, rid, d1, d2 (digest): for each chunk, its symbols with each one left out."""
    edges = chunk_edges(symbols, chunks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        factor = np.uint64(0x9E3779B97F4A7C15)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids = batch.column(0).to_numpy()
                signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(len(ids), symbols)
                digest = [pa.array(column) for column in np.ascontiguousarray(_digest(signs).T)]
                for low, high in zip(edges, edges[1:]):
                    for gap in range(low, high):
                        key = np.full(len(ids), gap + 1, np.uint64)  # says chunk and gap
                        for i in range(low, high):
                            if i != gap:
                                key = (key ^ (key >> np.uint64(31))) * factor + signs[:, i]
                        key = (key ^ (key >> np.uint64(32))) * factor
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)), batch.column(0), *digest], ["key", "rid", "d1", "d2"]
                        )

    return representatives.select("rid", "sig").mapInArrow(run, "key long, rid long, d1 long, d2 long")


def _runs(rows: DataFrame, groups: str, order: Column) -> DataFrame:
    """key, rid and hub with their digests: members whose value of ``groups`` is not that of the hub.

    The hub is the first member in the given order. Rows come sorted by bucket, so a bucket is a run
    of rows, and all that a task keeps of it is its hub.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        last_key, kept = None, (0, 0, 0, 0)
        for batch in batches:
            key, rid, d1, d2, group = (batch.column(i).to_numpy() for i in range(5))
            n = len(key)
            if not n:
                continue
            starts = np.concatenate([[True], key[1:] != key[:-1]])
            if last_key is not None and key[0] == last_key:
                starts[0] = False
            first = np.maximum.accumulate(np.where(starts, np.arange(n), -1))
            inherited = first < 0
            hub, h1, h2, hub_group = (
                np.where(inherited, old, own[first]) for old, own in zip(kept, (rid, d1, d2, group))
            )
            last_key, kept = key[-1], (hub[-1], h1[-1], h2[-1], hub_group[-1])
            keep = group != hub_group
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (key, rid, d1, d2, hub, h1, h2)],
                ["key", "rid", "d1", "d2", "hub", "h1", "h2"],
            )

    dealt = rows.select("key", "rid", "d1", "d2", F.col(groups).alias("_group"), order.alias("_order"))
    dealt = dealt.repartition("key").sortWithinPartitions("key", "_order", "rid").drop("_order")
    return dealt.mapInArrow(run, "key long, rid long, d1 long, d2 long, hub long, h1 long, h2 long")


def _alike(x1: str, x2: str, y1: str, y2: str) -> Column:
    first, second = (F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in ((x1, y1), (x2, y2)))
    return first + second <= DIGEST_RADIUS


def _pairs(found: DataFrame, most: int | None = None) -> DataFrame:
    """Members and hubs that may be alike; ``most`` of them for each member, chosen by hash."""
    close = found.where(_alike("d1", "d2", "h1", "h2") & (F.col("rid") != F.col("hub")))
    if most is not None:
        # A document is in as many buckets as there are symbols, so its list is bounded.
        own = F.sort_array(F.collect_set(F.struct(F.xxhash64("rid", "hub").alias("o"), "hub")))
        close = close.groupBy("rid").agg(F.slice(own, 1, most).alias("_hubs"))
        close = close.select("rid", F.explode("_hubs.hub").alias("hub"))
    return close.select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b")).distinct()


def _confirmed(pairs: DataFrame, signs: DataFrame, sets: DataFrame, radius: int, percent: int) -> DataFrame:
    """The pairs within the signature distance whose sets overlap enough, each as (a, b)."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(len(n), -1) for i in (4, 5)
            )
            fits = (x != y).sum(axis=1) <= radius
            fits &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(fits)) for i in (0, 1)], ["a", "b"]
            )

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            fits = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = len(x) + len(y) - len(np.union1d(x, y))
                fits.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(fits, pa.bool_())) for i in (0, 1)], ["a", "b"]
            )

    def joined(rows: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
        for side in ("a", "b"):
            own = table.select(F.col("rid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
            rows = rows.join(own, side)
        return rows.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])

    close = joined(pairs, signs, ["n", "sig"]).mapInArrow(near, "a long, b long")
    return joined(close, sets, ["shingles"]).mapInArrow(enough, "a long, b long")


def _parities(shingles):
    """Of each of 64 * PARITY_WORDS cells, whether an odd number of the shingles falls in it, as PARITY_WORDS numbers.

    A shingle that only one of two sets has turns one cell over, so no more cells differ than shingles do.
    """
    import numpy as np

    cells = 64 * PARITY_WORDS
    odd = np.bincount((shingles % np.uint64(cells)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _rare_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels that share one of their rarest shingles.

    Sets that overlap enough cannot differ in all of the ``n - percent * n / 100 + 1`` first shingles
    of any common order; in order of frequency, what makes an edited copy differ comes first, and
    copies too far from a group meet none of it. A shingle counts for a pair only where enough is left of both
    sets from it on: at the first shingle they share, all that they share is still to come. Nor does a pair
    count whose parities differ in more places than linked sets do in shingles. Frequencies are counted in
    2 ** RARE_BITS cells.
    """
    words = [f"p{i}" for i in range(PARITY_WORDS)]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        cells = np.zeros(1 << RARE_BITS, np.int64)
        for batch in batches:
            for body in batch.column(0):
                own = np.frombuffer(body.as_buffer(), "<u8") >> np.uint64(64 - RARE_BITS)
                np.add.at(cells, own.astype(np.int64), 1)
        found = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(cells[found])], ["cell", "n"])

    counted = rows.select("shingles").mapInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most 2 ** RARE_BITS rows
    import numpy as np

    cells = np.zeros(1 << RARE_BITS, np.int64)
    cells[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                firsts, parities = [], []
                for body in batch.column(4):
                    own = np.frombuffer(body.as_buffer(), "<u8")
                    parities.append(_parities(own))
                    n = len(own)
                    first = n - -(-percent * n // 100) + 1
                    order = np.lexsort((own, times[(own >> np.uint64(64 - RARE_BITS)).astype(np.int64)]))
                    firsts.append(own[order[:first]].view(np.int64))
                repeats = np.repeat(np.arange(len(firsts)), [len(f) for f in firsts])
                kept = [batch.column(i).take(pa.array(repeats)) for i in range(4)]
                sizes = np.array([len(b.as_buffer()) // 8 for b in batch.column(4)])
                left = np.concatenate([n - np.arange(len(f)) for n, f in zip(sizes, firsts)])
                odd = np.array(parities)[repeats]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts)), *kept, pa.array(sizes[repeats]), pa.array(left)]
                    + [pa.array(odd[:, i]) for i in range(PARITY_WORDS)],
                    ["shingle", "rid", "d1", "d2", "label", "n", "left", *words],
                )

    listed = rows.select("rid", "d1", "d2", "label", "shingles").mapInArrow(
        rarest,
        "shingle long, rid long, d1 long, d2 long, label long, n long, left long, "
        + ", ".join(f"{w} long" for w in words),
    )
    # Shingles of one label only need no partner.
    mixed = listed.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
    listed = materialize(listed.join(mixed.select("shingle"), "shingle"), "rarest")
    sides = [
        listed.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("rid", "d1", "d2", "label", "n", "left", *words)])
        for side in ("a", "b")
    ]
    apart = (F.col("rid_a") < F.col("rid_b")) & (F.col("label_a") != F.col("label_b"))
    sized = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    # At the first shingle that both have, what they share is no more than what either has left from there on.
    reach = (100 + percent) * F.least("left_a", "left_b") >= percent * (F.col("n_a") + F.col("n_b"))
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words])
    close = (100 + percent) * differ <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    met = sides[0].join(sides[1], "shingle").where(
        apart & sized & reach & _alike("d1_a", "d2_a", "d1_b", "d2_b") & close
    )
    return met.select(F.col("rid_a").alias("a"), F.col("rid_b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """rid, label of all nodes of the links (a, b): the label is the least node that is connected.

    Each round takes the least label around each node, then the label of that label.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    both = materialize(both, "links")
    labels = materialize(
        both.groupBy("a").agg(F.min("b").alias("_least")).select(
            F.col("a").alias("rid"), F.least("a", "_least").alias("label")
        ),
        "labels",
    )
    while True:
        around = (
            both.join(labels.withColumnRenamed("rid", "b"), "b").groupBy("a").agg(F.min("label").alias("_around"))
        )
        better = labels.join(around, labels["rid"] == around["a"]).select(
            "rid", F.col("label").alias("_old"), F.least("label", "_around").alias("_new")
        )
        above = labels.select(F.col("rid").alias("_new"), F.col("label").alias("_above"))
        moved = better.join(above, "_new", "left").select(
            "rid", F.least("_new", F.coalesce("_above", "_new")).alias("label"), "_old"
        )
        moved = materialize(moved, "labels")
        changed = not moved.where("label <> _old").isEmpty()
        labels = moved.select("rid", "label")
        if not changed:
            return labels


def near_duplicates(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = PERCENT,
    symbols: int = SYMBOLS,
    chunks: int = CHUNKS,
) -> DataFrame:
    """key, n_shingles, component_id, kept, text_hash and first of each row.

    ``component_id`` is the least key that links reach, the row's own if none; ``kept`` says that it is the
    row's own. A text without words (null or empty) is linked with nothing. Equal rows and rows
    with the same words are linked; rows that repeat a key are judged one by one and share that key
    as an id. A null key never is the least one and its row is not kept, unless nothing is known
    to be linked with it, where its component is null. ``first`` says that the row has the least (key,
    text hash) of what links reach, null keys last; equal rows share it. An empty table gives no rows.
    Other columns are ignored.
    """
    radius = 2 * chunks - 1
    spark = documents.sparkSession
    texts = documents.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_th"), F.col(text).alias("_text"))
    signed = _signatures(texts, words, symbols)
    path = scratch_dir(spark, "signatures")
    signed.write.parquet(path)
    signed = spark.read.schema(signed.schema).parquet(path)
    # One representative for each set; equal sets have equal signatures.
    home = F.struct(F.col("_key").isNull(), F.col("_key").alias("k"), F.col("_th").alias("t"))
    copies = signed.where("rid is not null").groupBy("rid").agg(
        F.min(home).alias("home"), F.min("n").alias("n"), F.min("sig").alias("sig"), F.count(F.lit(1)).alias("times")
    )
    copies = materialize(copies, "representatives")
    signs = copies.select("rid", "n", "sig")

    index = _index(copies, symbols, chunks)
    met = _runs(index.withColumn("same", F.col("rid")), "same", F.lit(0))
    met = materialize(met, "buckets")
    # Hubs are members as well; their own rows are not in the runs.
    members = met.select("key", "rid", "d1", "d2").union(met.select("key", "hub", "h1", "h2")).distinct()
    members = materialize(members, "members")
    # Texts of the documents that met another one, each by its home row.
    homes = members.select("rid").distinct().join(copies, "rid").select(
        "rid", F.col("home.k").alias("_key"), F.col("home.t").alias("_th")
    )
    homes = materialize(homes, "homes")
    listed = F.broadcast(homes) if fits_broadcast(homes, rows=1_000_000) else homes
    same = texts["_key"].eqNullSafe(listed["_key"]) & (texts["_th"] == listed["_th"])
    wanted = texts.join(listed, same).select("rid", "_text")
    sets = materialize(_sets(wanted, words).dropDuplicates(["rid"]), "sets")

    links, labels, last = None, None, False
    pairs = _pairs(met)
    for number in range(1, HUB_ROUNDS + 2):
        pairs = materialize(pairs, "pairs")
        new = materialize(_confirmed(pairs, signs, sets, radius, percent), "confirmed")
        linked = new.count()
        if links is None or linked:
            links = new if links is None else links.union(new)
            labels = components(links)
        if last:
            break
        # Buckets that still hold more than one component.
        own = members.join(labels, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
        split = own.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
        open_rows = materialize(own.join(split.select("key"), "key"), "open").select("key", "rid", "d1", "d2", "label")
        if open_rows.isEmpty():
            break
        members = open_rows.drop("label")
        last = number == HUB_ROUNDS or linked < LEAST_YIELD * pairs.count()
        if last:
            # All pairs of different components that share a bucket, unless their sets rule them out.
            open_sets = open_rows.select("rid", "d1", "d2", "label").distinct().join(sets, "rid")
            pairs = _rare_pairs(materialize(open_sets, "open-sets"), percent)
        elif number < FEW_HUBS:
            pairs = _pairs(_runs(open_rows, "label", F.xxhash64("rid", F.lit(number))))
        else:
            pairs = _pairs(_runs(open_rows, "label", F.xxhash64("rid", "key", F.lit(number))), HUBS_A_ROUND)

    named = copies.join(labels, "rid", "left").withColumn("label", F.coalesce("label", "rid"))
    least = named.groupBy("label").agg(F.min("home").alias("least"))
    # Only sets with company are looked up; the others are their own component.
    grouped = named.join(least, "label").where(
        (F.col("times") > 1) | ~F.col("least").eqNullSafe(F.col("home"))
    ).select("rid", F.col("least.k").alias("component"), F.col("least.t").alias("_least"))
    grouped = materialize(grouped, "components")
    small = F.broadcast(grouped) if fits_broadcast(grouped, rows=1_000_000) else grouped
    return (
        signed.join(small.withColumn("_known", F.lit(True)), "rid", "left")
        .withColumn("component_id", F.when(F.col("_known"), F.col("component")).otherwise(F.col("_key")))
        .select(
            F.col("_key").alias(key),
            F.col("n").alias("n_shingles"),
            "component_id",
            F.col("component_id").eqNullSafe(F.col("_key")).alias("kept"),
            F.col("_th").alias("text_hash"),
            (
                F.col("_known").isNull()
                | F.col("component").eqNullSafe(F.col("_key")) & (F.col("_least") == F.col("_th"))
            ).alias("first"),
        )
    )


def keep_first(documents: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """One row of each group of near-duplicates, as it is: the least (key, text hash), null keys last.

    Of rows with the same key and text the one with the least hash of the row stays; rows without words and
    key are linked with nothing and all stay. Other columns stay, whatever their names; an empty table gives no rows.
    """
    judged = near_duplicates(documents, key=key, text=text, words=words).where("first")
    nameless = F.col(key).isNull() & (F.coalesce(F.col("n_shingles"), F.lit(0)) == 0)
    good = judged.groupBy(F.col(key).alias("_k"), F.col("text_hash").alias("_t")).agg(
        F.count(F.lit(1)).alias("_times"), F.max(nameless).alias("_nameless")
    )
    good = materialize(
        good.select("_k", "_t", ((F.col("_times") > 1) & ~F.col("_nameless")).alias("_again")), "neardup-first"
    )
    same = documents[key].eqNullSafe(good["_k"]) & (F.xxhash64(documents[text]) == good["_t"])
    once = documents.join(good.where("not _again"), same, "left_semi")
    again = good.where("_again")
    if again.isEmpty():
        return once
    # Folded map-side, so that a hot row sends one row a task.
    names = documents.columns
    row = F.struct(*(F.col(f"`{n}`") for n in names))
    same = documents[key].eqNullSafe(again["_k"]) & (F.xxhash64(documents[text]) == again["_t"])
    folded = documents.join(again, same, "left_semi").groupBy(F.col(key), F.xxhash64(text)).agg(
        F.min_by(row, F.xxhash64(*(F.col(f"`{n}`") for n in names))).alias("_row")
    )
    return once.unionByName(folded.select("_row.*"))
