"""Line deduplication over the whole corpus: equal lines, and lines a few edits apart.

A line with a word in it is dropped if it repeats an earlier one, whatever its length; a line of at
least ``2 * edits + 2`` characters also if an earlier such line is within ``edits`` edits of it: shorter
ones cannot be cut into segments. Earlier means the smaller (doc_id, text hash, line number) of first
occurrences; a chain of near lines thus keeps only its first.

Near lines by segments: of ``edits + 1`` segments of the shorter line, one must occur unchanged in the
other, not far from its place. So each distinct line is indexed by its segments (number, length
and hash) and probes, for each length it may match, the substrings at the admissible places. Lines that
meet and have about the same letters (an exact bound) are verified by Spark's ``levenshtein`` with a
threshold, which computes the band of the matrix only.

Equal lines are folded map-side before any shuffle; distinct lines cross the network once, their
segments as two numbers each. Verdicts on lines are broadcast if measured small, else joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import WORD
from layerline.operators.scale import fits_broadcast, materialize

EDITS = 2
#: Segment keys and line numbers keep so many bits of a hash; what they bring together is verified.
KEY_BITS = 48
#: Sixteen letters that a sketch counts.
LETTERS = "etaoinshrdlumcbk"


def _short(column: Column) -> Column:
    return F.shiftrightunsigned(column, 64 - KEY_BITS)


def _identity(line: Column) -> list[Column]:
    """Two independent hashes: 128 bits that stand for a line."""
    return [F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(1), line).alias("_h2")]


def _segment(length: Column, number: int, count: int) -> tuple[Column, Column]:
    """Start (from 0) and size of a segment; the last ones are longer by one if need be."""
    size = F.floor(length / count).cast("int")
    longer = length % count
    ahead = F.greatest(F.lit(0), F.lit(number) - (F.lit(count) - longer)).cast("int")
    return size * number + ahead, size + (F.lit(number) >= F.lit(count) - longer).cast("int")


def _segment_key(number: int, length: Column, piece: Column) -> Column:
    return _short(F.xxhash64(F.lit(number), length, piece))


def segment_keys(line: Column, length: Column, edits: int) -> list[Column]:
    """Keys under which a line is found."""
    keys = []
    for i in range(edits + 1):
        start, size = _segment(length, i, edits + 1)
        keys.append(_segment_key(i, length, F.substring(line, start + 1, size)))
    return keys


def probe_keys(line: Column, length: Column, edits: int, less: Column) -> list[Column]:
    """Keys under which a line finds those that are shorter by ``less`` (0 to ``edits``), and nulls.

    For segment i the place may differ by what the edits before it and behind it allow. The places are
    functions of ``less``, so that the generated code stays small enough to be compiled.
    """
    keys = []
    short = length - less
    for i in range(edits + 1):
        start, size = _segment(short, i, edits + 1)
        low = F.greatest(F.lit(-i), less - (edits - i))
        high = F.least(F.lit(i), less + (edits - i))
        places = max(min(i, n + edits - i) - max(-i, n - edits + i) + 1 for n in range(edits + 1))
        for place in range(places):
            piece = F.substring(line, start + low + place + 1, size)
            keys.append(F.when(low + place <= high, _segment_key(i, short, piece)))
    return keys


def sketch(line: Column) -> Column:
    """How often each of LETTERS occurs, modulo 16, in 64 bits."""
    packed, left = F.lit(0).cast("long"), line
    for letter in LETTERS:  # the most frequent ones first, so that later ones are looked for in less
        rest = F.replace(left, F.lit(letter), F.lit(""))
        times = F.octet_length(left) - F.octet_length(rest)
        packed, left = F.shiftleft(packed, 4).bitwiseOR(times.cast("long").bitwiseAND(F.lit(15))), rest
    return packed


def may_be_near(x: str, y: str, edits: int) -> Column:
    """Whether the counts allow so few edits, each of which changes them by two at most: true of near lines."""
    apart = F.lit(0).cast("long")
    for i in range(len(LETTERS)):
        one, other = (F.shiftrightunsigned(c, 4 * i).bitwiseAND(F.lit(15)) for c in (x, y))
        by = F.abs(one - other)
        apart = apart + F.least(by, 16 - by)
    return apart <= 2 * edits


def _lines(documents: DataFrame, least_chars: int, words: bool) -> DataFrame:
    """_doc, _th (hash of the text), _at, _line of the lines that count; with ``words``, shorter ones that have one."""
    counts = F.length("_line") >= least_chars
    if words:
        counts = counts | F.regexp_like("_line", F.lit(WORD))
    return (
        documents.select("_doc", "_th", F.posexplode(F.split("_text", "\n")).alias("_at", "_line"))
        .where(counts)
    )


def near_pairs(lines: DataFrame, edits: int) -> DataFrame:
    """Candidates (_a, _b): short hashes of distinct lines that share a segment and may be near."""
    # Sketches are made before the shuffle, which both sides read.
    distinct = lines.select("_line", sketch(F.col("_line")).alias("_w")).distinct().select(
        "_line", "_w", F.length("_line").alias("_n"), _short(F.xxhash64("_line")).alias("_id")
    )
    line, n = F.col("_line"), F.col("_n")
    indexed = distinct.select(
        F.explode(F.array(*segment_keys(line, n, edits))).alias("_key"), F.col("_id").alias("_a"), F.col("_w").alias("_wa")
    )
    lengths = distinct.select("*", F.explode(F.array(*map(F.lit, range(edits + 1)))).alias("_less"))
    probing = lengths.select(
        F.explode(F.array(*probe_keys(line, n, edits, F.col("_less")))).alias("_key"),
        F.col("_id").alias("_b"),
        F.col("_w").alias("_wb"),
    ).where("_key is not null")
    met = indexed.join(probing, "_key").where(
        (F.col("_a") != F.col("_b")) & may_be_near("_wa", "_wb", edits)
    )
    return met.select(F.least("_a", "_b").alias("_a"), F.greatest("_a", "_b").alias("_b")).distinct()


def _within(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """Lines whose short hash is listed; by broadcast if the list is measured small."""
    listed = F.broadcast(ids) if fits_broadcast(ids) else ids
    return lines.withColumn("_id", _short(F.xxhash64("_line"))).join(listed, "_id", "left_semi")


def deduplicate(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int | None = None,
    edits: int = EDITS,
    counts: bool = True,
) -> DataFrame:
    """The documents with a new text and, unless ``counts`` is off, n_lines and n_dropped (long) at the end.

    All other columns stay, whatever their names; only with counts, columns named n_lines and n_dropped give way
    to them. A very long text is one row, its lines are many. A null text stays null and has no lines; an empty one has one empty
    line. Without ``least_chars``, equal lines go at any length if they have a word, near ones from
    ``2 * edits + 2`` characters on; with it, lines below it stay always. Rows with the same key and text count as one
    document: they keep the same lines. A null key comes first in the order. No row is dropped, a
    document whose lines all go has an empty text. An empty table gives no rows.
    """
    words = least_chars is None
    if least_chars is None:
        least_chars = 2 * edits + 2
    if least_chars < 2 * edits + 2:
        raise ValueError("lines must be long enough to be cut into segments")
    if counts and text in ("n_lines", "n_dropped"):
        raise ValueError("the text may not be named like a count")
    names = documents.columns
    # Other columns travel as one struct, so that no name of theirs meets one of those used here.
    rest = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names) if n != text]
    rows = documents.select(
        F.col(f"`{key}`").alias("_doc"), F.xxhash64(f"`{text}`").alias("_th"), F.col(f"`{text}`").alias("_text"),
        F.struct(F.lit(True).alias("here"), *rest).alias("_rest"),
    )
    lines = _lines(rows, least_chars, words)
    longer = lines.where(F.length("_line") >= least_chars) if words else lines
    place = F.struct("_doc", "_th", "_at")

    # Equal lines: only those found more than once, with their first place.
    repeated = (
        lines.select("_doc", "_th", "_at", *_identity(F.col("_line")))
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_times"), F.min(place).alias("_first"))
        .where("_times > 1")
        .select("_h1", "_h2", "_first", F.lit(False).alias("_all"))
    )
    # Near lines: candidates, then their texts and first places, then the exact distance.
    pairs = materialize(near_pairs(longer, edits), "line-pairs")
    involved = pairs.select(F.col("_a").alias("_id")).union(pairs.select(F.col("_b"))).distinct()
    known = _within(longer, involved).groupBy("_id", "_line").agg(F.min(place).alias("_first"))
    left = known.select(F.col("_id").alias("_a"), F.col("_line").alias("_x"), F.col("_first").alias("_fx"))
    right = known.select(F.col("_id").alias("_b"), F.col("_line").alias("_y"), F.col("_first").alias("_fy"))
    close = (
        pairs.join(left, "_a")
        .join(right, "_b")
        .where((F.col("_x") != F.col("_y")) & (F.levenshtein("_x", "_y", edits) >= 0))
    )
    later = F.when(F.col("_fx") < F.col("_fy"), F.col("_y")).otherwise(F.col("_x"))
    losers = close.select(later.alias("_line")).distinct().select(
        *_identity(F.col("_line")), F.lit(None).cast(repeated.schema["_first"].dataType).alias("_first"),
        F.lit(True).alias("_all"),
    )
    verdicts = materialize(
        repeated.unionByName(losers)
        .groupBy("_h1", "_h2")
        .agg(F.max("_all").alias("_all"), F.max("_first").alias("_first")),
        "line-verdicts",
    )
    small = F.broadcast(verdicts) if fits_broadcast(verdicts, rows=2_000_000) else verdicts
    dropped = (
        lines.select("_doc", "_th", "_at", *_identity(F.col("_line")))
        .join(small, ["_h1", "_h2"])
        .where(F.col("_all") | (place != F.col("_first")))
        .groupBy("_doc", "_th")
        # a document's own line numbers; distinct since equal rows have the same ones
        .agg(F.sort_array(F.collect_set("_at")).alias("_gone"))
        .withColumn("_found", F.lit(True))
    )
    dropped = materialize(dropped, "line-numbers")
    gone = F.broadcast(dropped) if fits_broadcast(dropped, rows=2_000_000) else dropped
    same = rows["_doc"].eqNullSafe(gone["_doc"]) & rows["_th"].eqNullSafe(gone["_th"])
    joined = rows.join(gone, same, "left").select(rows["_rest"], rows["_text"], gone["_gone"])
    split = joined.withColumn("_split", F.split("_text", "\n"))
    bounds = split.withColumn(
        "_bounds", F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size("_split")))
    )
    between = F.transform(
        F.sequence(F.lit(0), F.size("_gone")),
        lambda k: F.slice(
            "_split",
            F.get(F.col("_bounds"), k) + 2,
            F.get(F.col("_bounds"), k + 1) - F.get(F.col("_bounds"), k) - 1,
        ),
    )
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.flatten(between), "\n")
    )
    n_lines = F.when(F.col("_text").isNull(), 0).otherwise(F.coalesce(F.size("_split"), F.lit(0)))
    n_dropped = F.coalesce(F.size("_gone"), F.lit(0))
    added = {"n_lines": n_lines.cast("long"), "n_dropped": n_dropped.cast("long")} if counts else {}
    return bounds.select(
        *((kept if n == text else F.col(f"_rest.c{i}")).alias(n) for i, n in enumerate(names) if n not in added),
        *(c.alias(n) for n, c in added.items()),
    )
