"""N-gram Jaccard join by T-occurrence search, in the manner of DivideSkip.

A document is the set of its distinct word shingles. Two sets link when their overlap reaches T, which follows from their sizes. Of a
set's inverted lists only those of its first ``n - T + 1`` shingles need to be searched, in an order that all sets share (frequent
shingles of a sample of the documents last; any order gives the same links). Of these lists, short ones are merged: every two sets
of a list meet, and the number of lists in which two sets meet, with their last place in common, bounds their overlap. Long lists are
put aside: in them only a few leaders are compared with all others, and later, if a long list still holds several components, its
sets of different components, as far as the parities of their shingles' bins leave room for a link. Candidates that pass a count sketch (a lower bound of the difference) are probed: the smaller set is
looked up in the larger one by binary search, and sets whose overlap reaches T are linked. Equal sets are one from the start.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.components import components
from tallyframe.llm.shared import byte_texts, free_name, picked, sub_batches, written

SHORT_LIST, LEADERS, SKETCH, MOST_BITS, PARITIES = 64, 4, 256, 1 << 27, 16
def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """The sorted set of 64-bit hashes of a text's shingles: of ``words`` words each, or of all words if there are fewer. The hash is of the shingle's
    bytes, words lower-cased and joined by spaces."""
    word = text.lower().split()
    size = min(words, len(word))
    if not size:
        return np.zeros(0, np.uint64)
    found = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(word[i:] for i in range(size)))))
    return np.unique(np.fromiter(found, np.uint64, len(word) - size + 1))


def set_key(found: np.ndarray) -> int:
    """One number for a set, of its hashes' mixed sum and its size."""
    return int(mixed(np.array([mixed(found + np.uint64(len(found))).sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])


def first_lists(found: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], percent: int) -> tuple[np.ndarray, int]:
    """The shingles whose lists have to be searched, all but ``T - 1``: frequent ones last, by how frequent. And how many are not frequent."""
    values, ranks = frequent
    light = len(found)
    if len(values):
        at = np.minimum(np.searchsorted(values, found), len(values) - 1)
        often = values[at] == found
        light = int((~often).sum())
        found = np.concatenate((found[~often], found[often][np.argsort(ranks[at[often]])]))
    most = len(found) + (-percent * len(found)) // 100 + 1
    return found[:most], min(light, most)


def counted(found: np.ndarray) -> bytes:
    """How many shingles fall into each of ``SKETCH`` bins, modulo 256: two sets differ by at least the differences' sum."""
    return np.bincount((found >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH).astype(np.uint8).tobytes()


def frequent_shingles(rows: DataFrame, words: int, one_in: int = 16, most: int = 300_000) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of one in ``one_in`` texts (by hash), of those in two or more: at most ``most``, in order of value, and
    the place of each from the least frequent on. They only set the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            sets = [shingles(t, words) for t in byte_texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["s"])

    some = rows.where(F.pmod("th", F.lit(one_in)) == 0).dropDuplicates(["th"]).select("text").mapInArrow(run, "s long")
    often = some.groupBy("s").count().where("count > 1").orderBy(F.desc("count"), "s").limit(most).select("s").toArrow()["s"]
    values = often.to_numpy().view(np.uint64)
    order = np.argsort(values)
    return values[order], len(values) - order.astype(np.int32)


def indexed(rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """doc_id, th, key (null for an empty set), n and the shingles to search of every document, the first ``light`` of them not frequent."""
    shared = rows.sparkSession.sparkContext.broadcast(frequent)
    names = ["doc_id", "th", "key", "n", "light", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            sets = [shingles(t, words) for t in byte_texts(batch, "text")]
            firsts, lights = zip(*[first_lists(s, shared.value, percent) if len(s) else (s, 0) for s in sets])
            first = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(f) for f in firsts]))), pa.int32()), pa.array(np.concatenate(firsts).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("th"), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                                              pa.array([len(s) for s in sets], pa.int64()), pa.array(lights, pa.int64()), first], names=names)

    return written(rows.mapInArrow(run, "doc_id long, th long, key long, n long, light long, first array<bigint>"), "indexed")


def inverted(index: DataFrame) -> DataFrame:
    """(token, key, n, pos, df) of the lists of two sets or more. Lists of frequent shingles are counted first and joined; all others are short
    enough to be counted where they meet."""
    tokens = index.where("key is not null").dropDuplicates(["key"]).select("key", "n", "light", F.posexplode("first").alias("pos", "token"))
    light, heavy = (tokens.where(side).select("token", "key", "n", "pos") for side in ("pos < light", "pos >= light"))
    dfs = heavy.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    met = light.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
    return written(met.unionByName(heavy.join(dfs, "token")), "lists")


def size_fits(percent: int):
    return (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)


def first_fits(percent: int):
    """Whether two sets can link whose first shingle in common is at ``pa`` and ``pb``: no more than what follows it is shared."""
    return F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def sides(lists: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    return tuple(lists.select("token", *[F.col(c).alias(f"{c[0]}{side}" if c != "key" else side) for c in ("key", "n", "pos", *more)]) for side in "ab")


def candidates(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with a < b: from short lists those whose overlap can reach T, from long lists the leaders with all others."""
    long_rows = lists.where(F.col("df") > SHORT_LIST)
    big = long_rows.groupBy("key").agg(F.count("*").alias("big"))
    left, right = sides(lists.where(F.col("df") <= SHORT_LIST))
    met = left.join(right, "token").where((F.col("a") < F.col("b")) & size_fits(percent)).groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    met = met.join(big.toDF("a", "ba"), "a", "left").join(big.toDF("b", "bb"), "b", "left").fillna(0, ["ba", "bb"])
    most = F.col("c") + F.least("ba", "bb") + F.least(F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
    short = met.where(most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b", "na", "nb")
    chosen = long_rows.groupBy("token").agg(*[F.min_by(F.struct("key", "n"), F.xxhash64("key", F.lit(j))).alias(f"l{j}") for j in range(LEADERS)])
    led = long_rows.join(chosen.select("token", F.explode(F.array_distinct(F.array(*[f"l{j}" for j in range(LEADERS)]))).alias("leader")), "token")
    led = led.select(F.least("key", "leader.key").alias("a"), F.greatest("key", "leader.key").alias("b"), F.when(F.col("key") < F.col("leader.key"), F.col("n")).otherwise(F.col("leader.n")).alias("na"),
                     F.when(F.col("key") < F.col("leader.key"), F.col("leader.n")).otherwise(F.col("n")).alias("nb")).where((F.col("a") < F.col("b")) & size_fits(percent))
    return short.unionByName(led).distinct()


def parities(found: np.ndarray) -> np.ndarray:
    """Of each of ``64 * PARITIES`` bins, whether an odd number of shingles falls into it, as signed words. Two sets differ in at least as many shingles as
    bits differ."""
    odd = np.bincount((found & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def parity_fits(percent: int):
    """Whether the bits that differ leave room for a link."""
    off = functools.reduce(lambda x, y: x + y, [F.bit_count(F.col("xa")[i].bitwiseXOR(F.col("xb")[i])) for i in range(PARITIES)])
    return off * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)


def bitmap(numbers: DataFrame) -> np.ndarray:
    """A bitmap of the numbers in the first column by their low bits, of 64 to 128 bits for each number, ``MOST_BITS`` (16 MB) at most: what it lets through by chance
    is more work, never another result."""
    bits = min(MOST_BITS, 1 << max(18, (64 * numbers.count()).bit_length()))
    found = numbers.select((F.pmod(F.col(numbers.columns[0]), F.lit(bits)) + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    table = np.zeros(bits // 8, np.uint8)
    for part, those in found:
        table[(part - 1) * len(those):part * len(those)] = np.frombuffer(those, np.uint8)[:len(table) - (part - 1) * len(those)]
    return table


def marked(column: pa.ChunkedArray | pa.Array, table: np.ndarray) -> pa.Array:
    bit = column.to_numpy() % (8 * len(table))
    return pa.array(table[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 > 0)


def row_mark():
    """A number of a row's identifier and text: of equal texts one row is asked for its set."""
    return F.xxhash64("doc_id", "th")


def sets_of(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(key, shingles, sketch, parity) of the rows ``wanted`` (mark), from their texts, without a shuffle. A bitmap tells others apart before any
    work; one that passes by chance is a set that no pair names, or another copy of one."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in sub_batches(batches, "text"):
            batch = batch.filter(marked(batch.column("mark"), shared.value))
            out = []
            for mark, text in zip(batch.column("mark").to_pylist(), byte_texts(batch, "text")):
                if mark not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(mark)
                    found = shingles(text, words)
                    if len(found):
                        out.append((set_key(found), found.tobytes(), counted(found), parities(found)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())))], names=["key", "shingles", "sketch", "parity"])

    return written(rows.select(row_mark().alias("mark"), "text").mapInArrow(run, "key long, shingles binary, sketch binary, parity array<bigint>"), "sets")


def asked(sets: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """(key, column) of the sets that ``keys`` names, and of few others, each once: what has no use is left out before it is sent anywhere."""
    shared = sets.sparkSession.sparkContext.broadcast(bitmap(keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(marked(batch.column("key"), shared.value))

    return sets.select("key", column).mapInArrow(run, f"key long, {column} binary").dropDuplicates(["key"])


def probed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: first by the sketches, then by looking one set up in the other."""
    def kept(test):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = (batch.column(c).to_pylist() for c in ("xa", "xb"))
                good = [test(x, y, na, nb) for x, y, na, nb in zip(a, b, batch.column("na").to_pylist(), batch.column("nb").to_pylist())]
                yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b", "na", "nb"])

        return run

    def can_link(x, y, na, nb):
        off = np.frombuffer(x, np.uint8) - np.frombuffer(y, np.uint8)
        return int(np.minimum(off, -off).sum(dtype=np.int64)) * (100 + percent) <= (na + nb) * (100 - percent)

    def links(x, y, na, nb):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        small, large = (x, y) if len(x) <= len(y) else (y, x)
        common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
        return 100 * common >= percent * (na + nb - common)

    def step(those, column, test):
        a, b = (asked(sets, column, those.select(side)).toDF(side, f"x{side}") for side in "ab")
        return those.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "xa", "xb").mapInArrow(kept(test), "a long, b long, na long, nb long")

    return written(step(written(step(pairs, "sketch", can_link), "possible"), "shingles", links).select("a", "b"), "links")


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with the component of documents that it links to, directly or through others.

    Result, one row per document: doc_id, n_shingles, component_id (the smallest doc_id of the component), label (equal for the documents of a component; null
    for an empty set, which links with nothing), th (hash of the text). Null text has no words. A null doc_id is not smaller than any other; repeated rows are documents
    with equal sets; an empty table gives an empty result; other columns are ignored.
    """
    rows = picked(docs, doc_id=id_col, text=text_col).withColumn("th", F.xxhash64("text"))
    index = indexed(rows, frequent_shingles(rows, words), words, percent)
    sets = index.where("key is not null").groupBy("key").agg(F.min(row_mark()).alias("mark"), F.min("doc_id").alias("least_id"))
    lists = inverted(index)
    pairs = written(candidates(lists, percent), "candidates")
    long_lists = lists.where(F.col("df") > SHORT_LIST)
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).union(long_lists.select("key")).distinct()
    found = sets_of(rows, written(wanted.join(sets, "key").select("mark"), "wanted"), words)
    links = probed(pairs, found, percent)
    labels = components(links)
    # Long lists that are not one component yet: their sets of different components, as far as they were not compared.
    labelled = long_lists.join(labels, F.col("key") == F.col("node"), "left").select("token", "key", "n", "pos", F.coalesce("label", "key").alias("label"))
    split = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("token")
    parity = found.select("key", F.col("parity").alias("x")).dropDuplicates(["key"])
    left, right = sides(labelled.join(split, "token", "left_semi").join(parity, "key"), "label", "x")
    more = left.join(right, "token").where((F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & size_fits(percent) & first_fits(percent) & parity_fits(percent)).select("a", "b", "na", "nb").distinct()
    more = written(more.join(pairs, ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        labels = components(links.unionByName(probed(more, found, percent)))
    of_set = sets.join(labels, F.col("key") == F.col("node"), "left").select("key", "least_id", F.coalesce("label", "key").alias("label"))
    least = of_set.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = of_set.join(least, "label").select("key", "label", "component_id")
    return index.select("doc_id", F.col("n").alias("n_shingles"), "key", "th").join(named, "key", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "label", "th")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns: of each component the one with the smallest doc_id (null last, then by text hash), and all
    with an empty set (null, empty and blank texts). A row repeated with its identifier and text stays once; an empty table stays empty; columns may have
    any names."""
    def key(identifier, text_hash):
        return F.concat(F.coalesce(F.col(identifier).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text_hash.cast("string"), F.lit("-")))

    found = jaccard_join(docs, words, percent, id_col, text_col)
    first = found.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")).alias("f")).select("f.doc_id", "f.th")
    row = free_name(docs.columns, "row_key")
    stay = first.unionByName(found.where("label is null").select("doc_id", "th")).select(key("doc_id", F.col("th")).alias(row))
    marked = docs.withColumn(row, key(f"`{id_col}`", F.xxhash64(F.col(f"`{text_col}`"))))
    return marked.join(stay, row, "left_semi").dropDuplicates([row]).select(*[F.col(f"`{c}`") for c in docs.columns])
