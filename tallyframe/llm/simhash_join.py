"""SimHash near-dedup by the generalised pigeonhole principle.

A document's fingerprint has 64 bits: bit j is set if more than half of the hashes of its word shingles have it. Two fingerprints link when
at most ``distance`` bits differ. The bits are grouped into partitions, correlated ones together; a fingerprint gives every partition i a
threshold t_i >= -1 of its own (-1: not searched) with ``sum(t_i + 1) = distance + 1``. Whatever differs from it in at most ``distance``
bits then differs in at most t_i bits in some partition, so searching each partition within its own threshold loses nothing. The
thresholds come from a dynamic programme over estimated numbers of candidates, and so does the number of partitions: few wide ones, with
more probes, as fingerprints grow in number. Candidates are verified on all bits.

The estimates are histograms of blocks of at most 16 bits over all fingerprints, so their size does not depend on the input. A bucket
with more than ``SMALL_BUCKET`` fingerprints is not paired: those that meet in it are linked through the points near them (two
fingerprints within the distance share one), of which each has at most as many fingerprints as a ball has points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.components import components
from tallyframe.llm.shared import byte_texts, picked, sub_batches, written

SMALL_BUCKET, PROBE_COST, BLOCK = 64, 4.0, 16
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text cut between words into pieces of about ``size`` bytes."""
    start = 0
    while start < len(text):
        found = _SPACE.search(text, start + size)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def simhash(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of a UTF-8 text as an unsigned number; zero without words. Memory follows the longest word, not the text."""
    ones, n, last = np.zeros(64, np.int64), 0, []
    for piece in pieces(text):
        found = last + piece.lower().split()
        if count := max(0, len(found) - words + 1):
            ones += bit_counts(map(b" ".join, zip(*(found[i:] for i in range(words)))), count, seed)
            n += count
        last = found[max(0, len(found) - words + 1):]
    if not n and last:
        ones, n = bit_counts([b" ".join(last)], 1, seed), 1
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def bit_counts(shingles, count: int, seed: int) -> np.ndarray:
    """For each bit, how many of the shingles' hashes have it."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, count)
    return bits_of(hashes).sum(axis=0, dtype=np.int64)


def bits_of(numbers: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each number, the lowest bit first."""
    return np.unpackbits(numbers.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def values_at(bits: np.ndarray, places: list[int]) -> np.ndarray:
    """The bits at these places as one number for each row."""
    return bits[:, places].astype(np.int64) @ (np.int64(1) << np.arange(len(places), dtype=np.int64))


def fingerprinted(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) for every row; null text is empty. The texts are read once and go nowhere else."""
    rows = picked(docs, doc_id=id_col, text=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            found = np.array([simhash(t, words, seed) for t in byte_texts(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return written(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long"), "simhash")


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy().view(np.uint64)


def together(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and for every two bits how many have both."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            bits = bits_of(_numbers(batch)).astype(np.float32)
            both, n = both + bits.T @ bits, n + len(bits)
        i, j = np.triu_indices(64)
        cells = np.concatenate((both[i, j], [n])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    cells = np.zeros(64 * 65 // 2 + 1)
    for cell, n in fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect():
        cells[cell] = n
    both = np.zeros((64, 64))
    both[np.triu_indices(64)] = cells[:-1]
    return int(cells[-1]), np.maximum(both, both.T)


def correlated(n: int, both: np.ndarray) -> np.ndarray:
    """How far each two bits tell of one another, from 0 to 1; bits that never change tell all of each other and nothing of the rest."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(share * (1 - share))
    still = spread < 1e-9
    with np.errstate(divide="ignore", invalid="ignore"):
        found = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    return np.where(np.outer(still, still), 1.0, np.where(np.add.outer(still, still), 0.0, np.nan_to_num(found)))


def grouped_bits(likeness: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of nearly equal size. A group begins with the free bit that is most like the other free ones and takes
    in the one most like its members until it is full."""
    free, groups = list(range(64)), []
    for i in range(parts):
        group = [max(free, key=lambda b: (likeness[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < 64 // parts + (i < 64 % parts):
            group.append(max(free, key=lambda b: (likeness[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(group)
    return groups


def blocks(group: list[int]) -> list[list[int]]:
    """A group of bits in equal blocks of at most ``BLOCK``."""
    count = -(-len(group) // BLOCK)
    return [group[i * len(group) // count:(i + 1) * len(group) // count] for i in range(count)]


def histograms(fps: DataFrame, all_blocks: list[list[int]]) -> list[np.ndarray]:
    """For every block, how many fingerprints have each value of it: at most 2**16 numbers a block, whatever the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(block), np.int64) for block in all_blocks]
        for batch in batches:
            bits = bits_of(_numbers(batch))
            for count, block in zip(counts, all_blocks):
                count += np.bincount(values_at(bits, block), minlength=len(count))
        for i, count in enumerate(counts):
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(at), pa.array(count[at])], names=["block", "value", "n"])

    found = fps.select("fp").mapInArrow(run, "block long, value long, n long").groupBy("block", "value").agg(F.sum("n").alias("n")).toArrow()
    out = [np.zeros(1 << len(block)) for block in all_blocks]
    at, values, n = (found[c].to_numpy() for c in ("block", "value", "n"))
    for i, count in enumerate(out):
        count[values[at == i]] = n[at == i]
    return out


def at_distance(count: np.ndarray, distance: int) -> np.ndarray:
    """Row d: for every value, how many fingerprints have a value that differs from it in exactly d bits."""
    rows, place = np.zeros((distance + 1, len(count))), np.arange(len(count))
    rows[0] = count
    for bit in range(len(count).bit_length() - 1):
        rows[1:] += rows[:-1][:, place ^ (1 << bit)]
    return rows


class Plan:
    """Groups of bits and what it costs a fingerprint to search them."""

    def __init__(self, groups: list[list[int]], near: dict[tuple[int, ...], np.ndarray], n: int, distance: int):
        self.groups, self.n, self.distance = groups, n, distance
        self.near = [[near[tuple(block)].astype(np.float32) for block in blocks(group)] for group in groups]
        self.masks = [ball(len(group), distance) for group in groups]

    def costs(self, bits: np.ndarray) -> np.ndarray:
        """costs[i, u]: of searching group i with threshold u - 1, probes and estimated candidates; blocks count as independent of each other."""
        out = np.zeros((len(self.groups), self.distance + 2, len(bits)))
        for i, group in enumerate(self.groups):
            exact = np.zeros((self.distance + 1, len(bits)))
            exact[0] = 1
            for block, near in zip(blocks(group), self.near[i]):
                share = near[:, values_at(bits, block)] / max(self.n, 1)
                exact = np.stack([sum(exact[d - e] * share[e] for e in range(d + 1)) for d in range(self.distance + 1)])
            sizes = np.array([len(m) for m in self.masks[i]])
            out[i, 1:] = self.n * exact.cumsum(axis=0) + PROBE_COST * sizes.cumsum()[:, None]
        return out

    def allocated(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cheapest thresholds (a row for each group) of every fingerprint, and their cost: by dynamic programming over the groups, in which
        ``distance + 1`` units are given out and u units make a threshold of u - 1."""
        costs, units = self.costs(bits), self.distance + 2
        best = np.full((units, len(bits)), np.inf)
        best[0], taken = 0, []
        for cost in costs:
            every = np.stack([np.concatenate((np.full((u, len(bits)), np.inf), best[:units - u] + cost[u])) for u in range(units)])
            taken.append(every.argmin(axis=0))
            best = every.min(axis=0)
        left, out = np.full(len(bits), self.distance + 1), []
        for choice in reversed(taken):
            u = choice[left, np.arange(len(bits))]
            out.append(u - 1)
            left = left - u
        return np.stack(out[::-1]), best[self.distance + 1]


def ball(width: int, distance: int) -> list[np.ndarray]:
    """For d from 0 on, the numbers of ``width`` bits in which exactly d bits are set."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(width), d)], np.uint64).view(np.int64) for d in range(distance + 1)]


def total_costs(fps: DataFrame, plans: list[Plan]) -> list[float]:
    shared = fps.sparkSession.sparkContext.broadcast(plans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = bits_of(_numbers(batch))
            sums = [float(p.allocated(bits)[1].sum()) + PROBE_COST * len(p.groups) * len(bits) for p in shared.value]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["plan", "cost"])

    found = dict(fps.select("fp").mapInArrow(run, "plan long, cost double").groupBy("plan").agg(F.sum("cost")).collect())
    return [found.get(i, 0.0) for i in range(len(plans))]


def best_plan(fps: DataFrame, distance: int, parts: tuple[int, ...]) -> Plan:
    """The plan with the least cost over all fingerprints. The driver sees 2,081 sums, the histograms and a cost for each plan."""
    n, both = together(fps)
    likeness = correlated(n, both)
    groupings = [grouped_bits(likeness, m) for m in parts]
    every = list(dict.fromkeys(tuple(b) for groups in groupings for group in groups for b in blocks(group)))
    near = {b: at_distance(count, distance) for b, count in zip(every, histograms(fps, [list(b) for b in every]))}
    plans = [Plan(groups, near, n, distance) for groups in groupings]
    return min(zip(total_costs(fps, plans), range(len(plans)), plans))[2] if len(plans) > 1 else plans[0]


def keyed(fps: DataFrame, plan: Plan, probing: bool) -> DataFrame:
    """(part, value, fp): the values under which fingerprints are found, or with ``probing`` those where each one searches."""
    shared = fps.sparkSession.sparkContext.broadcast(plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fp = _numbers(batch.slice(start, 4096))
                bits = bits_of(fp)
                allowed = plan.allocated(bits)[0] if probing else np.zeros((len(plan.groups), len(fp)), np.int64)
                for i, group in enumerate(plan.groups):
                    value = values_at(bits, group)
                    for d, masks in enumerate(plan.masks[i]):
                        at = np.flatnonzero(allowed[i] >= d)
                        if len(at):
                            where = (value[at][:, None] ^ masks).ravel()
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(where), i, np.int32)), pa.array(where), pa.array(np.repeat(fp[at].view(np.int64), len(masks)))], names=["part", "value", "fp"])

    return fps.select("fp").mapInArrow(run, "part int, value long, fp long")


def linked_through_points(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect whatever is connected by links among these fingerprints. Two of them are within the distance if, and only if, some
    point is within half of it, rounded up, of one and half of it, rounded down, of the other; so all that are near a point link with its
    smallest fingerprint of the inner ball."""
    inner, rings = distance // 2, ball(64, distance - distance // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                fp = batch.column("fp").slice(start, 2048).to_numpy()
                for d, masks in enumerate(rings):
                    yield pa.RecordBatch.from_arrays([pa.array((fp[:, None] ^ masks).ravel()), pa.array(np.repeat(fp, len(masks))), pa.array(np.full(len(fp) * len(masks), d <= inner))], names=["point", "fp", "near"])

    points = fps.select("fp").mapInArrow(run, "point long, fp long, near boolean")
    least = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("point"))
    return points.select(F.col("fp").alias("a"), least.alias("b")).where("a <> b")


def near_links(fps: DataFrame, distance: int = 2, parts: tuple[int, ...] = (2, 3, 4)) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` at most ``distance`` bits apart, with which every such two are connected."""
    plan = best_plan(fps, distance, parts)
    index, probes = written(keyed(fps, plan, False), "simhash-index"), written(keyed(fps, plan, True), "simhash-probes")
    full = written(index.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > SMALL_BUCKET).select("part", "value"), "simhash-full")
    few = index.join(full, ["part", "value"], "left_anti").withColumnRenamed("fp", "b")
    met = probes.withColumnRenamed("fp", "a").join(few, ["part", "value"]).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).select("a", "b")
    crowded = written(index.unionByName(probes).join(full, ["part", "value"], "left_semi").select("fp").distinct(), "simhash-crowded")
    return met.unionByName(linked_through_points(crowded, distance))


def simhash_join(docs: DataFrame, words: int = 3, distance: int = 2, parts: tuple[int, ...] = (2, 3, 4), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its fingerprint and the component of documents that it links to, directly or through others.

    Result, one row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id of the component). Null text and text without
    words have fingerprint zero, which links like any other. A null doc_id is not smaller than any other; repeated rows are documents with equal
    fingerprints; ties cannot occur; an empty table gives an empty result; other columns are ignored, whatever their names.
    """
    rows = fingerprinted(docs, words, id_col=id_col, text_col=text_col)
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    labels = components(near_links(fps, distance, parts))
    of_fp = fps.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least_id", F.coalesce("label", "fp").alias("label"))
    least = of_fp.groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = written(of_fp.join(least, "label").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
