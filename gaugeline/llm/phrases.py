"""Phrase collocations: Toivonen mining of frequent word sequences, scored by their weakest cut."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import count as numbers

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.shingles import mixed
from gaugeline.llm.storage import stored

MIN_COUNT, LONGEST, TOP = 30, 4, 2000
#: One document in so many is in the sample; there a phrase needs LOWERED of its share of MIN_COUNT.
SAMPLE_ONE_IN, LOWERED = 8, 0.8
#: A phrase that holds at least this part (in hundredths) of a shorter one's occurrences replaces it.
HELD = 80
#: Fixed size of a signature; with more phrases it lets more windows be counted, never fewer.
SIGNATURE_BITS = 26
#: Bytes of text whose words are coded together, and words counted together in a task.
BLOCK, FLUSH = 2**18, 2**18
#: Parts that may be shared by very many phrases, single words, are dealt to so many slots in joins.
SLOTS = 16

FACTOR = np.uint64(0x9E3779B97F4A7C15)
BLANK, BREAK = 0x20, 0xFF  # the second is in no UTF-8 text
FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\xff" * 10 + b" ")
LONG_WORD = re.compile(rb"[^ \xff]{65,}")
KEYS = ["w1", "w2", "w3", "w4"]
TABLE = pa.schema([*((key, pa.int64()) for key in KEYS), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
COUNTED = "w1 long, w2 long, w3 long, w4 long, lang string, word string, n long"


def folded(text: bytes | None, long_words: dict[bytes, bytes]) -> bytes:
    """A text with A-Z in lower case, blanks between words, and a BREAK between pieces and at the end.

    Words above 64 bytes are replaced by shorter names that no text can hold, and
    ``long_words`` takes them down.
    """

    def named(match: re.Match) -> bytes:
        name = b"\xfe" + xxhash.xxh3_128_hexdigest(match[0]).encode()
        long_words[name] = match[0]
        return name

    return LONG_WORD.sub(named, (text or b"").translate(FOLDED)) + b"\xff"


def blocks_of(data: bytes) -> Iterator[bytes]:
    """A folded text in parts of at most BLOCK bytes, cut between words."""
    at = 0
    while len(data) - at > BLOCK:
        end = 1 + max(data.rfind(b" ", at, at + BLOCK), data.rfind(b"\xff", at, at + BLOCK))
        yield data[at:end]
        at = end
    yield data[at:]


class WordCodes:
    """64-bit codes of all words of a block at once, in two independent lanes.

    A word's code is a polynomial of its bytes modulo 2**64, mixed with the code
    of its language. Sums over the block give it for every word without a loop.
    """

    def __init__(self, salt: int):
        chance = np.random.default_rng(salt)
        self.letters = chance.integers(1, 2**64, (2, 256), np.uint64)
        self.powers, self.inverses = [], []
        for base in chance.integers(0, 2**61, 2).tolist():
            base = 8 * base + 3
            for table, step in ((self.powers, base), (self.inverses, pow(base, -1, 2**64))):
                steps = np.full(BLOCK + 1, step, np.uint64)
                steps[0] = 1
                table.append(np.multiply.accumulate(steps))
        self.salt = salt

    def language(self, name: str) -> int:
        return xxhash.xxh3_64_intdigest(name, self.salt)

    def of(self, data: bytes, ends: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Words and breaks in order: codes (0 for a break), checks by the second lane, start and stop in the data.

        ``ends`` are the ends of the parts of the data, ``langs`` their languages' codes.
        """
        low = np.frombuffer(data, np.uint8)
        inside = (low != BLANK) & (low != BREAK)
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        places = np.flatnonzero((edge[:-1] == 1) | (low == BREAK))
        word = inside[places]
        lang = langs[np.searchsorted(ends, starts, side="right")]
        lanes, until = [], places.copy()
        until[word] = stops
        for letters, powers, inverses in zip(self.letters, self.powers, self.inverses):
            sums = np.zeros(len(low) + 1, np.uint64)
            np.cumsum(letters[low] * powers[: len(low)], out=sums[1:])
            own = mixed(mixed((sums[stops] - sums[starts]) * inverses[starts]) ^ lang)
            own[own == 0] = 1
            lane = np.zeros(len(places), np.uint64)
            lane[word] = own
            lanes.append(lane)
        return *lanes, places, until


class Signature:
    """A set of phrases as bits of a fixed number: what was added is always found."""

    def __init__(self, words: np.ndarray):
        self.bits = words.view(np.uint8)

    @classmethod
    def of(cls, phrases: DataFrame, length: int) -> Signature:
        """Of rows (w1 .. w4) with so many words; tasks and the shuffle merge bits, the driver gets these alone."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = [column.to_numpy().view(np.uint64) for column in batch.columns]
                at = cls.places(phrase_hashes(words)[-1])
                slots, inverse = np.unique(at >> 6, return_inverse=True)
                bits = np.zeros(len(slots), np.uint64)
                np.bitwise_or.at(bits, inverse, np.uint64(1) << (at & 63).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(bits.view(np.int64))], names=["slot", "bits"])

        merged = phrases.select(KEYS[:length]).mapInArrow(work, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
        found = merged.toArrow()
        words = np.zeros(2 ** (SIGNATURE_BITS - 6), np.int64)
        words[found["slot"].to_numpy()] = found["bits"].to_numpy()
        return cls(words)

    @staticmethod
    def places(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - SIGNATURE_BITS)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def phrase_hashes(words: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the first, the first two ... words of phrases given as columns of codes."""
    with np.errstate(over="ignore"):
        out = [mixed(words[0])]
        for column in words[1:]:
            out.append(mixed(out[-1] * FACTOR + column))
    return out


def window_hashes(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of all windows of 1 to ``longest`` codes, by length and start; as ``phrase_hashes``."""
    out = [mixed(codes)]
    with np.errstate(over="ignore"):
        for k in range(1, longest):
            out.append(mixed(out[-1][: max(len(codes) - k, 0)] * FACTOR + codes[k:]))
    return out


def both(found: np.ndarray) -> np.ndarray:
    """Whether the window's prefix and its suffix, one shorter, are both in ``found``."""
    return found[:-1] & found[1:]


def proposed_windows(codes: np.ndarray, hashes: list[np.ndarray], proposed: list[Signature]) -> list[np.ndarray]:
    """By length, which windows are proposed or on the negative border, and so counted first.

    Every single word is. A longer phrase is if its prefix and suffix are proposed:
    it is then proposed itself, or a border phrase.
    """
    counted, inside = [codes != 0], None
    for length, signature in enumerate(proposed, 1):
        inside = counted[-1] & signature.has(hashes[length - 1])
        counted.append(both(inside))
    return counted


def expanded_windows(
    codes: np.ndarray, hashes: list[np.ndarray], proposed: list[Signature], frequent: list[Signature]
) -> list[np.ndarray]:
    """By length, windows not counted before of which every counted part is frequent."""
    counted = proposed_windows(codes, hashes, proposed)
    wanted, possible = [np.zeros(len(codes), bool)], counted[0] & frequent[0].has(hashes[0])
    for length in range(2, len(counted) + 1):
        open_ = both(possible)
        wanted.append(open_ & ~counted[length - 1])
        if length <= len(frequent):
            possible = open_ & (~counted[length - 1] | frequent[length - 1].has(hashes[length - 1]))
    return wanted


class CodedStream:
    """The words of a task's texts as a stream of codes, taken FLUSH at a time.

    The last words of a portion stand before the next one again, so that no
    window is lost where a long text is cut; ``overlap`` tells how many.
    """

    def __init__(self, salt: int):
        self.codes_of = WordCodes(salt)
        self.parts, self.size = [], 0  # folded blocks that are not coded yet: data, language, long words
        self.coded, self.words = [], 0
        self.tail, self.overlap = np.zeros((2, 0), np.uint64), 0

    def add(self, text: bytes | None, lang: str) -> Iterator[None]:
        """Take up a text; stops whenever a portion is ready to be taken."""
        long_words: dict[bytes, bytes] = {}
        for block in blocks_of(folded(text, long_words)):
            if self.size + len(block) > BLOCK:
                self.encode()
            self.parts.append((block, lang, long_words))
            self.size += len(block)
            if self.words >= FLUSH:
                yield

    def encode(self) -> None:
        if not self.parts:
            return
        blocks, langs, long_words = zip(*self.parts)
        data, ends = b"".join(blocks), np.cumsum([len(block) for block in blocks])
        lang_codes = {lang: self.codes_of.language(lang) for lang in set(langs)}
        found = self.codes_of.of(data, ends, np.array([lang_codes[lang] for lang in langs], np.uint64))
        names = {name: word for own in long_words for name, word in own.items()}
        self.coded.append((data, ends, langs, names, *found))
        self.words += len(found[0])
        self.parts, self.size = [], 0

    def take(self):
        """Codes and checks of the portion, and a function from places to their languages and words."""
        coded = self.coded
        lanes = [np.concatenate([self.tail[k], *(part[4 + k] for part in coded)]) for k in (0, 1)]
        self.overlap = self.tail.shape[1]
        borders = self.overlap + np.cumsum([0, *(len(part[4]) for part in coded)])

        def spelled(places: np.ndarray) -> tuple[pa.Array, pa.Array]:
            own = np.searchsorted(borders, places, side="right") - 1
            words, names = np.empty(len(places), object), np.empty(len(places), object)
            for k, (data, ends, langs, long_words, _, _, starts, stops) in enumerate(coded):
                here = np.flatnonzero(own == k)
                at = places[here] - borders[k]
                found = [data[a:b] for a, b in zip(starts[at].tolist(), stops[at].tolist())]
                words[here] = [long_words.get(word, word) for word in found] if long_words else found
                names[here] = [langs[i] for i in np.searchsorted(ends, starts[at], side="right").tolist()]
            return pa.array(names, pa.string()), pa.array(words, pa.binary()).cast(pa.string())

        self.tail = np.stack([lane[max(len(lane) - 3, 0) :] for lane in lanes])
        self.coded, self.words = [], 0
        return *lanes, spelled


def count_windows(docs: DataFrame, salt: int, chosen, lengths: range) -> DataFrame:
    """Occurrences of chosen windows: (w1 .. w4, lang, word, n); words unused are 0.

    ``chosen(codes, hashes)`` gives by length which windows of the codes to count,
    code 0 being a break. Single words carry their language and text; a row of code
    0 tells that two words share a code. Occurrences are summed over FLUSH words in
    the task, then on the map side of the shuffle.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = CodedStream(salt)
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                for _ in stream.add(text.as_py(), lang.as_py()):
                    yield from counted(stream)
        stream.encode()
        yield from counted(stream)

    def counted(stream: CodedStream) -> Iterator[pa.RecordBatch]:
        codes, checks, spelled = stream.take()
        old = stream.overlap
        hashes = window_hashes(codes, max(lengths))
        for length, places in zip(numbers(1), chosen(codes, hashes)):
            if length not in lengths:
                continue
            starts = np.flatnonzero(places)
            starts = starts[starts + length > old]  # windows that end before were counted by the last call
            if not len(starts):
                continue
            starts = starts[np.argsort(hashes[length - 1][starts])]
            columns = [codes[starts + k] for k in range(length)]
            new = np.ones(len(starts), bool)
            new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
            first = np.flatnonzero(new)
            out = [pa.array(x[first].view(np.int64)) for x in columns]
            out += [pa.array(np.zeros(len(first), np.int64))] * (4 - length)
            lang = word = pa.nulls(len(first), pa.string())
            if length == 1:
                lang, word = spelled(starts[first])
                if (checks[starts][1:] != checks[starts][:-1])[~new[1:]].any():  # two words share a code
                    yield pa.RecordBatch.from_pylist([dict.fromkeys([*KEYS, "n"], 0) | {"lang": "", "word": ""}], TABLE)
            table = pa.RecordBatch.from_arrays([*out, lang, word, pa.array(np.diff([*first, len(starts)]))], schema=TABLE)
            for low in range(0, table.num_rows, 65536):
                yield table.slice(low, 65536)

    texts = docs.select(F.col("text").cast("string").cast("binary"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return texts.mapInArrow(work, COUNTED).groupBy(*KEYS, "lang", "word").agg(F.sum("n").alias("n"))


def mine_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, one_in: int = SAMPLE_ONE_IN, lowered: float = LOWERED
) -> tuple[DataFrame, DataFrame]:
    """All sequences of up to ``longest`` (2 to 4) words that occur ``min_count`` times, with exact counts.

    Toivonen's way: a sample of the documents proposes phrases at a lowered
    threshold, level by level; one pass over all documents counts the proposed
    phrases and the negative border, those whose prefix and suffix are proposed.
    Where a border phrase turns out to be frequent, longer phrases may have been
    missed, and a further pass counts every window whose counted parts are all
    frequent, whatever its length. A frequent phrase has frequent parts, so nothing
    is open after that pass. The sample decides about speed only.

    Proposed and frequent phrases reach the tasks as signatures of fixed size.
    Phrases are told apart by the 64-bit codes of their words; codes shared by two
    words are looked for, and a salt with such a clash is given up for the next.

    Returns (phrases, words): phrases (w1 .. w4, n), unused words 0, single words
    too; words (w1, lang, word, n) of every distinct word of a language.
    """
    spark = docs.sparkSession
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0)
    enough = max(1, int(min_count / one_in * lowered + 0.5))
    for salt in numbers():
        shared = spark.sparkContext.broadcast([])
        for length in range(1, longest):
            found = count_windows(sample, salt, _chosen(proposed_windows, shared), range(length, length + 1))
            levels = [*shared.value, Signature.of(found.where(F.col("n") >= enough), length)]
            shared = spark.sparkContext.broadcast(levels)
        proposed = shared
        counted = stored(
            count_windows(docs, salt, _chosen(proposed_windows, proposed), range(1, longest + 1)).where((F.col("n") >= min_count) | (F.col("w2") == 0)),
            "phrase-counts",
        )
        words = counted.where("w2 = 0").select("w1", "lang", "word", "n")
        if words.groupBy("w1").count().where("count > 1 or w1 = 0").isEmpty():
            break
    phrases = counted.where(F.col("n") >= min_count).select(*KEYS, "n")
    if not _outside(phrases, proposed, longest):
        return phrases, words
    by_length = [phrases.where(_length() == length) for length in range(1, longest)]
    frequent = spark.sparkContext.broadcast([Signature.of(rows, length) for length, rows in enumerate(by_length, 1)])
    more = count_windows(docs, salt, _chosen(expanded_windows, proposed, frequent), range(2, longest + 1))
    more = stored(more.where(F.col("n") >= min_count).select(*KEYS, "n"), "phrase-expansion")
    return phrases.unionByName(more), words


def _chosen(rule, *shared):
    return lambda codes, hashes: rule(codes, hashes, *(levels.value for levels in shared))


def _length() -> Column:
    return sum(((F.col(key) != 0).cast("int") for key in KEYS[1:]), F.lit(1))


def _outside(phrases: DataFrame, proposed, longest: int) -> bool:
    """Whether a frequent phrase shorter than the longest was not proposed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [column.to_numpy().view(np.uint64) for column in batch.columns[:4]]
            length = 1 + sum((x != 0).astype(int) for x in words[1:])
            hashes, out = phrase_hashes(words), np.zeros(len(length), bool)
            for k, signature in enumerate(proposed.value):
                own = length == k + 1
                out[own] = ~signature.has(hashes[k][own])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(int(out.any()), 1))], names=["missed"])

    return not phrases.where(_length() < longest).mapInArrow(work, "missed long").isEmpty()


def _slot(own: list[str], part: list[str]) -> Column:
    """The slot a row looks in for one of its parts: single words lie in every slot."""
    return F.when(F.col(part[1]) == 0, F.pmod(F.xxhash64(*own), F.lit(SLOTS))).otherwise(0)


def score_phrases(phrases: DataFrame) -> DataFrame:
    """Phrases of two words or more with their weakest cut: (w1 .. w4, a, l, r, score).

    The score of a cut is floor(2000000 * a / (l + r)); the lowest counts, ties go
    to the shorter first part.
    """
    slots = F.when(F.col("w2") == 0, F.sequence(F.lit(0), F.lit(SLOTS - 1))).otherwise(F.array(F.lit(0)))
    counts = phrases.withColumn("slot", F.explode(slots))
    padded = F.array(*KEYS, F.lit(0), F.lit(0), F.lit(0))
    cuts = phrases.where("w2 <> 0").withColumn("k", F.explode(F.sequence(F.lit(1), _length() - 1)))
    parts = {"l": [F.when(F.col("k") > i, F.col(KEYS[i])).otherwise(F.lit(0)) for i in range(4)]}
    parts["r"] = [F.get(padded, F.col("k") + i) for i in range(4)]
    rows = cuts.select(*KEYS, F.col("n").alias("a"), "k", *(c.cast("long").alias(f"{side}{i}") for side, own in parts.items() for i, c in enumerate(own)))
    for side in "lr":
        own = [f"{side}{i}" for i in range(4)]
        rows = rows.withColumn("slot", _slot(KEYS, own).cast("int"))
        part = counts.select(*(F.col(key).alias(name) for key, name in zip(KEYS, own)), "slot", F.col("n").alias(side))
        rows = rows.join(part, [*own, "slot"]).drop(*own, "slot")
    score = F.expr("cast(2000000 * cast(a as decimal(20, 0)) div (cast(l as decimal(20, 0)) + r) as long)")
    rows = rows.withColumn("packed", score * 4 + F.col("k"))  # a score is 1,000,000 at most
    lowest = rows.groupBy(*KEYS, "a").agg(F.min("packed").alias("packed"), F.min_by("l", "packed").alias("l"), F.min_by("r", "packed").alias("r"))
    return lowest.withColumn("score", F.shiftright("packed", 2)).drop("packed")


def drop_held(scored: DataFrame, held: int = HELD) -> DataFrame:
    """Without phrases of which a longer phrase holds ``held`` hundredths of the occurrences."""
    spans = [(low, high) for low in range(4) for high in range(low + 2, 5) if high - low < 4]
    inside = [
        F.when(_length() >= high, F.struct(*(F.col(KEYS[low + i]).alias(KEYS[i]) if low + i < high else F.lit(0).cast("long").alias(KEYS[i]) for i in range(4))))
        for low, high in spans
    ]
    parts = scored.withColumn("part", F.explode(F.array_compact(F.array(*inside)))).where(
        F.col("part") != F.struct(*KEYS)
    )
    longer = parts.groupBy(*(F.col(f"part.{key}").alias(key) for key in KEYS)).agg(F.max("a").alias("longer"))
    joined = scored.join(longer, KEYS, "left")
    gone = F.expr(f"100 * cast(longer as decimal(20, 0)) >= {held} * cast(a as decimal(20, 0))")
    return joined.where(F.col("longer").isNull() | ~gone).drop("longer")


def top_collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, held: int = HELD, **mining) -> DataFrame:
    """Each language's best phrases: (lang, rank, phrase, a, l, r, n, score).

    Null text: empty. Null lang: ``und``, together with documents that say so.
    Repeated rows each count. Texts of any length are taken whole. Ties of score
    and count are ranked by the phrase. Empty table, or no phrase that is frequent:
    no rows. Other columns play no part, whatever their names.
    """
    phrases, words = mine_phrases(docs, min_count, **mining)
    phrases = stored(phrases, "frequent-phrases")
    kept = drop_held(stored(score_phrases(phrases), "scored-phrases"), held)
    frequent = words.where(F.col("n") >= min_count)
    slots = F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1)))
    langs = frequent.select("w1", "lang", slots.alias("slot"))
    placed = kept.withColumn("slot", F.pmod(F.xxhash64(*KEYS), F.lit(SLOTS)).cast("int")).join(langs, ["w1", "slot"]).drop("slot")
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    first = stored(placed.withColumn("place", F.rank().over(best)).where(F.col("place") <= top).drop("place"), "best-phrases")
    spelled = (
        first.select(*KEYS, F.posexplode(F.array(*KEYS)).alias("at", "code")).where("code <> 0")
        .join(frequent.select(F.col("w1").alias("code"), "word"), "code")
        .groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        .select(*KEYS, F.concat_ws(" ", "spelled.word").alias("phrase"))
    )
    sums = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = first.join(spelled, KEYS).join(sums, "lang").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
