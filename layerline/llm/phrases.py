"""Collocations: exact counts of phrases by tries over the whole text, level by level.

The text is read once: each word becomes a 63-bit hash of its language and itself, pieces and documents end
with 0, and distinct words are counted along the way. Two words with one hash are looked for among all
words, and another seed is taken if there are any, so nothing is approximate. Frequent words then get
dense numbers (other words become 0), which is the form that all later passes read.

Level by level, for phrases of 2 to ``longest`` words:

1. A task finds the places where a phrase can be frequent (Apriori: where the frequent phrase one word
   shorter is followed by a frequent word and, if one trie holds them all, by another such phrase), and
   sends each distinct phrase of its text once with its count there, ``least`` at most. Phrases whose sums
   reach ``least`` are the candidates; no other can be frequent.
2. Candidates become a double-array trie, which is broadcast: at most ``TRIE_PHRASES`` of them, more
   follow in tries of their own. numpy advances the states of all places of a block of text at once, a
   level at a time, and accepting states are counted by bincount; the tasks' counts are summed.

A pass that counts one level also finds the candidates of the next. Scores and rules are joins over the
counts of frequent phrases.

Hot words and phrases are folded in each task before they are shuffled. Memory of a task: a block of
``BLOCK_TOKENS`` words (or one longer document), of which ``WALKED`` places are looked at, ``GATHERED`` phrases, ``WORDS_HELD`` words and a trie. The
driver holds one trie, and the hashes of ``DICTIONARY_WORDS`` frequent words; further words are numbered in further
passes.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerline.operators.scale import materialize

LEAST = 30
LONGEST = 4
LIMIT = 2_000
UNNAMED = "und"
#: A phrase goes if a longer candidate that holds it has this share of its occurrences, in percent.
COVERED = 80

BLOCK_TOKENS = 2 << 20
GATHERED = 3 << 20
WORDS_HELD = 400_000
DICTIONARY_WORDS = 4 << 20
TRIE_PHRASES = 1 << 20
#: Places of a block that advance through the trie at once.
WALKED = 1 << 18
ROWS_OUT = 100_000
#: Texts that a worker gets at once; blocks come one by one.
TEXTS_IN = 1_000

#: A-Z in lower case, ends of pieces as one mark, tabs as blanks; the mark is one of the ends.
END = b"."
BYTES = bytes(
    c + 32 if 65 <= c <= 90 else END[0] if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)
NUMBERS = ["w1", "w2", "w3", "w4"]


class _Words(dict):
    """Numbers of the words of one language, as 4 bytes, in order of their first place; 0 ends a piece."""

    def __init__(self, lang: str, seed: int) -> None:
        self._lang, self._seed = lang.encode("utf-8", "surrogatepass") + b" ", seed
        self.words, self.codes = [b""], array("q", [0])
        self[END] = bytes(4)

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        self[word] = number = len(self.words).to_bytes(4, "little")
        self.words.append(word)
        self.codes.append((xxhash.xxh64_intdigest(self._lang + word, self._seed) >> 1) or 1)
        return number


def _read(documents: DataFrame, seed: int) -> DataFrame:
    """Rows of blocks of text (their distinct hashes, the place of each word among them), and of counted words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = ["lang", "word", "code", "n", "codes", "places"]
        packed = zstandard.ZstdCompressor(level=1).compress
        known: dict[str, _Words] = {}
        blocks: dict[str, list[bytes]] = {}
        counts: dict[str, object] = {}
        tokens = 0

        def texts() -> Iterator[pa.RecordBatch]:
            for lang, block in blocks.items():
                numbers = np.frombuffer(b"".join(block), "<i4")
                words = known[lang]
                found = np.bincount(numbers, minlength=len(words.words))
                if lang in counts:
                    found[: len(counts[lang])] += counts[lang]
                counts[lang] = found
                present = np.flatnonzero(np.bincount(numbers, minlength=1))
                place = np.zeros(len(words.words), np.int32)
                place[present] = np.arange(len(present))
                held = [np.array(words.codes)[present].tobytes(), packed(place[numbers].tobytes())]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                     *(pa.array([h], pa.binary()) for h in held)], names)
            blocks.clear()

        def words() -> Iterator[pa.RecordBatch]:
            for lang, own in known.items():
                for at in range(1, len(own.words), ROWS_OUT):
                    part = slice(at, at + ROWS_OUT)
                    size = len(own.words[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * size, pa.string()), pa.array(own.words[part], pa.binary()).view(pa.string()),
                         pa.array(np.array(own.codes[part]), pa.int64()), pa.array(counts[lang][part], pa.int64()),
                         pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary())], names)
            known.clear()
            counts.clear()

        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = body.as_buffer()
                if text is None:
                    continue
                if lang not in known:
                    known[lang] = _Words(lang, seed)
                found = text.to_pybytes().translate(BYTES).replace(END, b" " + END + b" ").split()
                blocks.setdefault(lang, []).append(b"".join(map(known[lang].__getitem__, found)) + bytes(4))
                tokens += len(found) + 1
                if tokens >= BLOCK_TOKENS:
                    yield from texts()
                    tokens = 0
                    if sum(len(own.words) for own in known.values()) >= WORDS_HELD:
                        yield from words()
        yield from texts()
        yield from words()

    return documents.mapInArrow(run, "lang string, word string, code long, n long, codes binary, places binary")


def _numbered(blocks: DataFrame, numbers, last: bool) -> DataFrame:
    """Hashes that are in the sorted array become minus their number; at the end, all words are numbers of 32 bits.

    Words without a number end as 0, and several 0 in a row as one. Frequent words have small numbers, so the
    text is small once compressed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        known, own = numbers.value
        packed, unpacked = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for held, places in zip(batch.column(0), batch.column(1)):
                codes = np.frombuffer(held.as_buffer(), "<i8")
                if len(known):
                    at = np.searchsorted(known, codes)
                    at[at == len(known)] = 0
                    codes = np.where(known[at] == codes, -own[at].astype(np.int64), codes)
                if last:
                    text = np.where(codes < 0, -codes, 0).astype("<i4")[np.frombuffer(unpacked(places.as_buffer()), "<i4")]
                    kept = np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])[: len(text)]
                    arrays = [pa.array([b""], pa.binary()), pa.array([packed(text[kept].tobytes())], pa.binary())]
                else:
                    arrays = [pa.array([codes.tobytes()], pa.binary()), pa.array([places.as_py()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["codes", "places"])

    return blocks.select("codes", "places").mapInArrow(run, "codes binary, places binary")


class Trie:
    """A double array over phrases of equal length, words being numbers from 1 on.

    A word is two symbols, its number divided by ``radix`` and the rest, so no state has more than ``radix``
    children. The root is state 0; the child of state s by a symbol is ``base[s] + symbol``, if ``check`` has s
    there; ``accepts`` has the phrase, from 1, that ends there.
    """

    def __init__(self, base, check, accepts, phrases, radix: int) -> None:
        self.arrays = base, check, accepts, phrases, radix
        self.base, self.check, self.accepts, self.phrases, self.radix = self.arrays
        self.depth = phrases.shape[1]

    def walk(self, text):
        """(places, phrases from 0) of all occurrences in a text of numbers."""
        import numpy as np

        padded = np.concatenate([text, np.zeros(self.depth, text.dtype)])
        places = np.flatnonzero(text).astype(np.int32)
        states = np.zeros(len(places), np.int32)
        for level in range(self.depth):
            words = padded[places + level]
            places, states, words = places[words > 0], states[words > 0], words[words > 0]
            for number in range(2):
                symbols = words % self.radix if number else words // self.radix
                ahead = self.base[states] + symbols
                # Beyond either end, take() gives an entry that belongs to nobody.
                fits = self.check.take(ahead, mode="clip") == states
                places, states, words = places[fits], ahead[fits], words[fits]
        return places, self.accepts[states] - 1


class _Builder:
    """Places the children of each state where all of them are free, states with many children first."""

    #: How far it looks, first near and then farther.
    WINDOWS = (512, 8_192)

    def __init__(self, size: int) -> None:
        import numpy as np

        self.used = np.zeros(size, bool)
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.top = 1

    def grow(self, size: int) -> None:
        import numpy as np

        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.used = np.concatenate([self.used, np.zeros(more, bool)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def take(self, states, parents) -> None:
        self.used[states] = True
        self.check[states] = parents
        self.top = max(self.top, int(states.max()) + 1)

    def place(self, parents, words):
        """States of children that lie together by parent, words ascending."""
        import numpy as np

        starts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        counts = np.diff(np.append(starts, len(parents)))
        states = np.zeros(len(parents), np.int64)
        several = np.flatnonzero(counts > 1)
        at = 1
        for i in several[np.argsort(-counts[several], kind="stable")].tolist():
            own = slice(starts[i], starts[i] + counts[i])
            steps = words[own] - words[starts[i]]
            first, at = self._fit(steps, at)
            states[own] = first + steps
            self.take(states[own], parents[own])
        single = starts[counts == 1]
        if len(single):
            self.grow(self.top + len(single))
            states[single] = np.flatnonzero(~self.used[1:])[: len(single)] + 1
            self.take(states[single], parents[single])
        self.base[parents] = states - words
        return states

    def _fit(self, steps, at: int) -> tuple[int, int]:
        """Where all steps are free, and from where to look next time; behind the last state if need be."""
        import numpy as np

        span = int(steps[-1]) + 1
        self.grow(self.top + span + 1)
        for window in self.WINDOWS:
            end = min(at + window, len(self.used) - span)
            places = np.flatnonzero(~self.used[at:end]) + at
            if window == self.WINDOWS[0] and len(places) < window // 8 and end == at + window:
                at = end  # too crowded to look there again
                continue
            for step in steps[1:17].tolist():
                places = places[~self.used[places + step]]
            for place in places[:64].tolist():
                if len(steps) < 18 or not self.used[place + steps].any():
                    return place, at
        return self.top, at


def build_trie(phrases, words: int) -> Trie:
    """Of an array with a row for each phrase; words are numbers up to ``words``."""
    import numpy as np

    phrases = phrases[np.lexsort(phrases.T[::-1])].astype(np.int32)
    radix = math.isqrt(words) + 1
    symbols = np.stack([phrases // radix, phrases % radix], axis=2).reshape(len(phrases), -1).astype(np.int64)
    builder = _Builder(2 * radix + 2 + 2 * symbols.size)
    builder.used[0] = True
    changes = np.zeros(len(phrases), bool)
    changes[:1] = True
    states = np.zeros(len(phrases), np.int64)
    for column in symbols.T:
        changes[1:] |= column[1:] != column[:-1]
        first = np.flatnonzero(changes)  # one phrase for each child of this level
        states = builder.place(states[first], column[first])[np.cumsum(changes) - 1]
    size = builder.top + 1  # the last entry belongs to nobody
    builder.grow(size)
    accepts = np.zeros(size, np.int32)
    accepts[states] = np.arange(1, len(phrases) + 1)
    return Trie(builder.base[:size].copy(), builder.check[:size].copy(), accepts, phrases, radix)


def _pass(blocks: DataFrame, trie, alone: bool, extend: bool, least: int) -> DataFrame:
    """Rows (w1 to w4, counted, n): phrases of the trie with their counts, and longer ones to try.

    Without a trie, pairs of frequent words are to be tried.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        unpacked = zstandard.ZstdDecompressor().decompress
        own = Trie(*trie.value) if trie else None
        depth = own.depth if own else 1
        counts = np.zeros(len(own.phrases) if own else 0, np.int64)
        gathered: list = []

        def rows(phrases, numbers, counted: bool) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(numbers), ROWS_OUT):
                part = phrases[at : at + ROWS_OUT]
                columns = [part[:, i] if i < part.shape[1] else np.zeros(len(part), np.int32) for i in range(4)]
                arrays = [pa.array(c.astype(np.int32)) for c in columns]
                arrays += [pa.array(np.full(len(part), counted)), pa.array(numbers[at : at + ROWS_OUT])]
                yield pa.RecordBatch.from_arrays(arrays, [*NUMBERS, "counted", "n"])

        def found() -> Iterator[pa.RecordBatch]:
            """What is gathered, sorted in one place; of the rows only those of a batch are made at a time."""
            codes = np.concatenate(gathered) if gathered else np.zeros(0, np.int64)
            gathered.clear()
            codes.sort()
            starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)]).astype(np.int32)
            times = np.minimum(np.diff(np.append(starts, len(codes))), least)
            codes = codes[starts]
            del starts
            for at in range(0, len(codes), ROWS_OUT):
                part = codes[at : at + ROWS_OUT]
                heads, lasts = part >> 32, (part & 0xFFFFFFFF).astype(np.int32)
                heads = own.phrases[heads] if own else heads.astype(np.int32)[:, None]
                yield from rows(np.column_stack([heads, lasts]), times[at : at + ROWS_OUT].astype(np.int64), False)

        def phrases_in(text) -> Iterator[tuple]:
            """(places, phrases) of a block, a stretch of places after the other.

            A stretch reads on for the one place behind it, so that it sees what follows its last place.
            """
            for at in range(0, len(text), WALKED):
                part = text[at : at + WALKED + 1 + depth]
                if own:
                    places, phrases = own.walk(part)
                else:
                    places = np.flatnonzero(part)
                    phrases = part[places]
                inside = np.searchsorted(places, WALKED)  # the places that are the stretch's own
                yield part, places[: min(len(places), inside + 1)], phrases[:inside]

        size = 0
        for batch in batches:
            for body in batch.column(0):
                text = np.frombuffer(unpacked(body.as_buffer()), "<i4")
                for part, places, phrases in phrases_in(text):
                    if own:
                        counts += np.bincount(phrases, minlength=len(counts))
                    if not extend or not len(phrases):
                        continue
                    here = places[: len(phrases)]
                    padded = np.concatenate([part, np.zeros(depth + 1, part.dtype)])
                    follows = padded[here + depth] > 0
                    if alone:  # the next place must hold a frequent phrase as well
                        after = np.append(places[1:], -1)[: len(here)]
                        follows &= after == here + 1
                    gathered.append(phrases[follows].astype(np.int64) << 32 | padded[here[follows] + depth])
                    size += len(gathered[-1])
                    if size >= GATHERED:
                        yield from found()
                        size = 0
        yield from found()
        there = np.flatnonzero(counts)
        if len(there):
            yield from rows(own.phrases[there], counts[there], True)

    return blocks.select("places").mapInArrow(run, "w1 int, w2 int, w3 int, w4 int, counted boolean, n long")


def _summed(passes: DataFrame, least: int, label: str) -> DataFrame:
    found = passes.groupBy(*NUMBERS, "counted").agg(F.sum("n").alias("n"))
    return materialize(found.where(F.col("n") >= least), label, batch_rows=1)


def _words(documents: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks of hashes, frequent words (lang, word, code, n), words of each language (lang, total))."""
    for seed in range(8):
        rows = materialize(_read(documents, seed), "phrase-text", batch_rows=TEXTS_IN)
        counted = rows.where(F.col("codes").isNull()).groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))
        counted = materialize(counted, "phrase-words")
        if counted.groupBy("code").count().where("count > 1").isEmpty():
            totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
            return rows.where(F.col("codes").isNotNull()).select("codes", "places"), counted.where(F.col("n") >= least), totals
    raise RuntimeError("words share hashes under every seed")


def count_phrases(
    documents: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, words, totals) of all that occur ``least`` times or more.

    phrases: w1 to w4 (numbers of words, 0 where there is none) and n, single words included; words: id, lang,
    word; totals: lang and its number of words. A null language is ``und``; null and empty texts
    have no words.
    """
    import numpy as np

    spark = documents.sparkSession
    own = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNNAMED)).alias("lang"), F.col(text).alias("text"))
    blocks, frequent, totals = _words(own, least)
    size = frequent.count()
    parts = max(1, -(-size // DICTIONARY_WORDS))
    step = (1 << 63) // parts + 1
    numbers, first = [], 1
    for part in range(parts):
        inside = F.col("code").between(part * step, min((part + 1) * step, 1 << 63) - 1)
        chosen = frequent.where(inside).select("code", "n").toArrow()
        codes, times = (chosen.column(c).to_numpy() for c in ("code", "n"))
        codes = codes[np.lexsort((codes, -times))]
        ids = np.arange(first, first + len(codes), dtype=np.int32)
        order = np.argsort(codes)
        shared = spark.sparkContext.broadcast((codes[order], ids[order]))
        blocks = materialize(_numbered(blocks, shared, part == parts - 1), "phrase-numbers", batch_rows=1)
        shared.destroy()
        ids = pa.table({"code": pa.array(codes, pa.int64()), "id": pa.array(ids)})
        numbers.append(materialize(spark.createDataFrame(ids), "phrase-ids"))
        first += len(codes)
    words = frequent.join(reduce(DataFrame.unionByName, numbers), "code")
    words = materialize(words.select("id", "lang", "word", "n"), "phrase-dictionary")

    found = [words.select(F.col("id").alias("w1"), *(F.lit(0).alias(w) for w in NUMBERS[1:]), "n")]
    tried = _summed(_pass(blocks, None, True, True, least), least, "phrase-level")
    for length in range(2, longest + 1):
        candidates = tried.where("not counted").select(*NUMBERS[:length])
        parts = -(-candidates.count() // TRIE_PHRASES)
        passes = []
        for part in range(parts):
            chosen = candidates.where(F.pmod(F.xxhash64(*NUMBERS[:length]), F.lit(parts)) == part).toArrow()
            phrases = np.column_stack([c.to_numpy() for c in chosen.columns])
            if not len(phrases):
                continue
            shared = spark.sparkContext.broadcast(build_trie(phrases, first).arrays)
            own = _pass(blocks, shared, parts == 1, length < longest, least)
            passes.append(own if parts == 1 else materialize(own, "phrase-pass", batch_rows=1))
            if parts > 1:
                shared.destroy()
        if not passes:
            break
        tried = _summed(reduce(DataFrame.union, passes), least, "phrase-level")
        found.append(tried.where("counted").select(*NUMBERS, "n"))
    return reduce(DataFrame.union, found), words.select("id", "lang", "word"), totals


def _phrase(*names: str):
    """A phrase as a struct of its numbers."""
    return F.struct(*(F.col(n).alias(w) if n else F.lit(0).alias(w) for n, w in zip([*names, *[""] * 4], NUMBERS)))


def collocations(
    documents: DataFrame,
    *,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    longest: int = LONGEST,
    limit: int = LIMIT,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``limit`` collocations.

    Words are parted by blanks and tabs, pieces by ``.,;:!?`` and line ends; A-Z are lower-cased. ``a`` counts all
    occurrences of a phrase of 2 to ``longest`` words (4 at most) within pieces, overlaps included, ``l`` and ``r``
    those of its two parts at the cut with the lowest score floor(2000000 a / (l + r)), the first of several;
    ``n`` counts the language's words. Phrases that a longer candidate covers go (``COVERED`` percent).
    Ties: a descending, then the phrase by its bytes.

    A null language is ``und``, together with the language of that name; null and empty texts have no words;
    equal rows count each; very long texts are read whole; an empty table gives no rows; other
    columns are ignored.
    """
    if not 2 <= longest <= 4:
        raise ValueError("phrases have 2 to 4 words")
    counts, words, totals = count_phrases(documents, lang=lang, text=text, least=least, longest=longest)
    sized = counts.select(_phrase(*NUMBERS).alias("p"), "n")
    candidates = counts.where("w2 > 0").select(_phrase(*NUMBERS).alias("p"), *NUMBERS, F.col("n").alias("a"))

    cuts = F.array(
        F.struct(F.lit(1).alias("k"), _phrase("w1").alias("left"), _phrase("w2", "w3", "w4").alias("right")),
        F.when(F.col("w3") > 0, F.struct(F.lit(2).alias("k"), _phrase("w1", "w2").alias("left"), _phrase("w3", "w4").alias("right"))),
        F.when(F.col("w4") > 0, F.struct(F.lit(3).alias("k"), _phrase("w1", "w2", "w3").alias("left"), _phrase("w4").alias("right"))),
    )
    cut = candidates.select("p", "a", F.explode(F.filter(cuts, lambda c: c.isNotNull())).alias("c"))
    left = sized.select(F.col("p").alias("left"), F.col("n").alias("l"))
    right = sized.select(F.col("p").alias("right"), F.col("n").alias("r"))
    cut = cut.select("p", "a", "c.*").join(left, "left").join(right, "right")
    # Decimals, as the products may pass 64 bits.
    cut = cut.withColumn("score", F.expr("(2000000 * cast(a AS decimal(20, 0))) div (cast(l AS decimal(20, 0)) + r)"))
    lowest = cut.groupBy("p").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))

    inner = F.filter(
        F.array(
            F.when(F.col("w3") > 0, _phrase("w1", "w2")),
            F.when(F.col("w3") > 0, _phrase("w2", "w3")),
            F.when(F.col("w4") > 0, _phrase("w3", "w4")),
            F.when(F.col("w4") > 0, _phrase("w1", "w2", "w3")),
            F.when(F.col("w4") > 0, _phrase("w2", "w3", "w4")),
        ),
        lambda p: p.isNotNull(),
    )
    covers = candidates.select(F.explode(inner).alias("p"), "a").groupBy("p").agg(F.max("a").alias("longer"))
    covered = F.expr(f"100 * cast(longer AS decimal(20, 0)) >= {COVERED} * cast(a AS decimal(20, 0))")
    free = lowest.join(covers, "p", "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")

    spelt = free.select("p", F.posexplode(F.array(*(f"p.{w}" for w in NUMBERS))).alias("at", "id")).where("id > 0")
    spelt = spelt.join(words, "id").groupBy("p").agg(
        F.max("lang").alias("lang"),
        F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"])).alias("phrase"),
    )
    rows = free.join(spelt, "p").join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "c.l", "c.r", F.col("total").alias("n"), "c.score"
    )
