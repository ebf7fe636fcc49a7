"""Quantile forecasts by gradient boosting over shared histograms.

The pinball loss is boosted: each round fits one tree for each quantile to the loss gradient on a bag of rows, takes
as leaf value the exact weighted quantile of the leaf's residuals, and moves the fit by a fraction of that.

Features are binned once, into blocks of a few thousand rows. A level of the trees is one pass over the blocks: it sums rows, weights
and weights below the fit by (quantile, node, feature, bin), for all quantiles at once, of left children only; the right ones
are what is left of their parents. Leaf values come from passes that count residuals by ranges of their 64-bit codes, each
a 4,096th of the one before, until few enough are left to be fetched. Where a few tasks hold all blocks, one pass gives the leaf
values: each task sends the residuals around its own quantile, which hold the exact one or show that they don't. These also bound each
leaf value, which tells of nearly all rows whether they will lie below the next fit; so the pass takes along the root sums of the next round,
with the few rows left open sent one by one and added by the driver once the value is known. For some likely root splits it takes along the next
level too; they are guesses from the sums of the last level's pass, where the tasks' own quantiles of the nodes stand in for leaf values.
Where the exact root sums name another split, that level takes its own pass. Sums are added up in a tree of tasks; the driver sees one array of
sums for each pass, whose size depends on the model alone. Blocks with the current fit are kept in memory every few rounds and are
made from the stored rows and the trees so far, so a lost executor costs its blocks and no lineage builds up.

The passes are array work on whole blocks with a dense sum at the end, which rows and grouped cells would only make
larger; this is the one place that uses the RDD interface.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline import params
from ebbline.functions.text import clean_items
from ebbline.operators.split import apply_split, group_split
from ebbline.plans import packed
from ebbline.plans.panel import TAG_FIELDS, TAG_PREFIX
from ebbline.plans.training import fit_medians, model_rows, sample_weight, usable_features
from ebbline.session import new_path

BLOCK_ROWS = 16_384
_TASK_BLOCKS = 8  # blocks of a task where there are more than one for each core
_KEPT_ROUNDS = 10  # after so many rounds blocks are made anew with the fit so far
_CELLS = 4_096  # ranges of a counting pass
_FEW_TASKS = 16  # sums of so many tasks are added up at once
_FETCHED = 200_000  # residuals of all leaves that are fetched at most
_AROUND = 1_000_000  # residuals around the quantiles of the tasks' packed rows that are sent at most
_PART_ROWS = 1_048_576  # packed rows of a task where there are more than one for each core
_SPREAD = 4.0  # a task's quantile is trusted to be so many standard deviations from that of all rows; what isn't is seen
_GUESSES = 2  # likely root splits of a quantile for which the next level is taken along
_SLACK = 1 - 1e-12  # sums of weights differ in their last bits by the order of addition


@dataclass(frozen=True)
class BoostingConfig:
    quantiles: tuple[float, ...] = params.QUANTILES
    rounds: int = params.N_TREES
    learning_rate: float = params.LEARNING_RATE
    max_depth: int = params.MAX_DEPTH
    min_leaf_rows: int = params.MIN_LEAF_ROWS
    subsample: float = params.SUBSAMPLE
    test_share: float = params.TEST_SHARE
    max_bins: int = 64
    seed: int = params.SEED


@dataclass
class QuantileModel:
    """Trees of every quantile, and what is needed to rebuild their feature vector."""

    features: list[str]
    medians: dict[str, float]
    vocabulary: dict[str, list[str]]
    learning_rate: float
    start: dict[float, float] = field(default_factory=dict)
    trees: dict[float, list[dict]] = field(default_factory=dict)

    @property
    def feature_names(self) -> list[str]:
        tags = [f"{TAG_PREFIX[k]}{t}" for k in TAG_FIELDS for t in self.vocabulary.get(k, [])]
        return self.features + tags


def feature_vector(rows: DataFrame, model: QuantileModel, output: str = "features") -> DataFrame:
    """Imputed numeric features and 0/1 tags as one sparse-aware vector."""
    filled = {f"_num_{c}": F.coalesce(F.col(c).cast("double"), F.lit(model.medians[c])) for c in model.features}
    out = rows.withColumns(filled)
    inputs = list(filled)
    for kind, source in TAG_FIELDS.items():
        words = model.vocabulary.get(kind, [])
        if words:
            hot = f"_{kind}_hot"
            out = out.withColumn(f"_{kind}", clean_items(F.col(source)))
            vectorizer = CountVectorizerModel.from_vocabulary(words, f"_{kind}", hot)
            out = vectorizer.setBinary(True).transform(out).drop(f"_{kind}")
            inputs.append(hot)
    assembled = VectorAssembler(inputCols=inputs, outputCol=output).transform(out)
    return assembled.drop(*inputs)


def learned_thresholds(train: DataFrame, columns: list[str], max_bins: int) -> dict[str, list[float]]:
    """Where each feature may be split: between all its values if these are at most ``max_bins``, else at its quantiles."""
    about = train.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first() if columns else {}
    few = [c for c in columns if about[c] <= 2 * max_bins]
    out: dict[str, list[float]] = {}
    if few:
        values = train.select(few).unpivot([], few, "name", "value").filter("value is not null").distinct()
        # At most some twice ``max_bins`` values each, but for errors of the estimate.
        listed = values.groupBy("name").agg(F.sort_array(F.collect_list("value")).alias("values"), F.count("*").alias("n"))
        for row in listed.filter(F.col("n") <= max_bins).collect():
            out[row["name"]] = [(a + b) / 2 for a, b in zip(row["values"], row["values"][1:])]
    many = [c for c in columns if c not in out]
    if many:
        shares = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
        cuts = train.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in many]).first()
        out |= {c: sorted(set(cuts[c])) if cuts[c] else [] for c in many}
    return out


def _kernels() -> SimpleNamespace:
    """The work of one block. Made inside a function, so that workers need not have this package."""

    def codes(values: np.ndarray) -> np.ndarray:
        """Numbers as unsigned integers in the same order."""
        bits = np.abs(values).view(np.int64)
        return (np.where(values < 0, -bits, bits)).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)

    def decoded(code: np.ndarray) -> np.ndarray:
        bits = (code ^ np.uint64(1 << 63)).view(np.int64)
        return np.where(bits < 0, -1.0, 1.0) * np.abs(bits).view(np.float64)

    def nodes(bins: np.ndarray, tree: dict) -> np.ndarray:
        """The node of each row: children of node i are 2i+1 and 2i+2; a row stays where there is no split."""
        at = np.zeros(bins.shape[1], np.min_scalar_type(-2 * len(tree["feature"]) - 2))
        # Node by node, parents first: comparing whole rows of bins takes a fraction of looking up a bin for each row.
        for node in np.flatnonzero(tree["feature"][: 2 ** tree["levels"] - 1] >= 0).tolist():
            below = bins[tree["feature"][node]] <= tree["cut"][node]
            at += (at == node) * (at.dtype.type(node + 2) - below)
        return at

    def grow(bins: np.ndarray, tree: dict) -> np.ndarray:
        return nodes(bins, tree).astype(np.int64)

    def fitted(block: dict, start: list[float], trees: list[list[dict]]) -> np.ndarray:
        """The fit of each quantile, from nothing, added up in order of the rounds."""
        fit = np.repeat(np.array(start)[:, None], len(block["delta"]), axis=1)
        return advanced(block, fit, trees)

    def advanced(block: dict, fit: np.ndarray, trees: list[list[dict]]) -> np.ndarray:
        fit = fit.copy()
        for of_round in trees:
            for q, tree in enumerate(of_round):
                fit[q] += tree["value"][nodes(block["bins"], tree)]
        return fit

    def bagged(block: dict, number: int, seed: int, share: float) -> np.ndarray:
        """A hash of row and round decides; the rows of a bag are the same however blocks are cut."""
        if share >= 1:
            return np.ones(len(block["delta"]), bool)
        x = block["row_hash"].view(np.uint64) + np.uint64((number * 0x9E3779B97F4A7C15 + seed * 0xBF58476D1CE4E5B9) % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * 2**64))

    def prepared(block: dict, wide: int) -> dict:
        """Where a block has few distinct weights, these and the pairs of tags and rows, for ``counts``."""
        kinds, kind = np.unique(block["weight"], return_inverse=True)
        if len(kinds) > 4:
            return block
        tag, row = np.nonzero(block["bins"][wide:])
        return block | {"kinds": kinds, "kind": kind.astype(np.uint8), "tags": (tag.astype(np.int32), row.astype(np.int32))}

    def counts(block: dict, fit: np.ndarray, bag: np.ndarray, trees: list[dict], wide: int, n_bins: int) -> np.ndarray:
        """What ``histograms`` gives, from one count of rows by weight and side of the fit for all three sums."""
        out = []
        bins, (tag, tag_row), kinds = block["bins"], block["tags"], block["kinds"]
        n_tags, n_codes = len(bins) - wide, 2 * len(kinds)

        def by_kind(found: np.ndarray) -> np.ndarray:
            """Rows, weight and weight below the fit from ``[..., kind, side of the fit]``, the number of rows."""
            every, below = found.sum(axis=-1), found[..., 1]
            return np.stack([every.sum(axis=-1), *[sum(c[..., k] * w for k, w in enumerate(kinds)) for c in (every, below)]], axis=-1).reshape(-1, 3)

        for q, tree in enumerate(trees):
            level = tree["levels"]
            first, n_nodes = 2**level - 1, max(1, 2 ** (level - 1))
            if level or not q:  # the roots have the same rows
                at = grow(bins, tree)
                here = bag & (at >= first)
                if level:
                    here &= at % 2 == 1  # left children have odd numbers
                rows, seats = np.flatnonzero(here), (at - first) // 2 if level else at
                columns, held = np.take(bins[:wide], rows, axis=1), here[tag_row]
                hot_rows = tag_row[held]
                hot = tag[held] * np.int64(n_nodes) + seats[hot_rows]
            code = block["kind"] * np.uint8(2) + (block["delta"] <= fit[q])
            place = seats[rows] * n_codes + code[rows]
            dense = np.array([np.bincount(place * n_bins + column, None, n_nodes * n_codes * n_bins) for column in columns])
            dense = by_kind(dense.reshape(wide, n_nodes, len(kinds), 2, n_bins).transpose(0, 1, 4, 2, 3))
            ones = by_kind(np.bincount(hot * n_codes + code[hot_rows], None, n_tags * n_nodes * n_codes).reshape(-1, len(kinds), 2)).reshape(n_tags, n_nodes, 3)
            total = by_kind(np.bincount(place, None, n_nodes * n_codes).reshape(-1, len(kinds), 2))
            out += [dense.ravel(), np.stack([total - ones, ones], axis=2).ravel(), total.ravel()]
        return np.concatenate(out)

    def histograms(block: dict, fit: np.ndarray, bag: np.ndarray, trees: list[dict], wide: int, n_bins: int) -> np.ndarray:
        """``[quantile, node, feature, bin, (rows, weight, weight below the fit)]`` of the left nodes of a level, or of the root.

        Features up to ``wide`` have ``n_bins`` bins, the others two.
        """
        if "kinds" in block:
            return counts(block, fit, bag, trees, wide, n_bins)
        out = []
        bins, weight = block["bins"], block["weight"]
        for q, tree in enumerate(trees):
            level = tree["levels"]
            first, n_nodes = 2**level - 1, max(1, 2 ** (level - 1))
            if level or not q:  # the roots have the same rows
                at = grow(bins, tree)
                here = bag & (at >= first)
                if level:
                    here &= at % 2 == 1  # left children have odd numbers
                rows = np.flatnonzero(here)
                seat = (at[rows] - first) // 2 if level else np.zeros(len(rows), np.int64)
                cells = [seat * n_bins + bins[f, rows] for f in range(wide)]
                plain = [[np.bincount(c, s, n_nodes * n_bins) for s in (None, weight[rows])] for c in cells]
                hot = bins[wide:, rows].astype(np.float64)
            stats = [None, weight[rows], weight[rows] * (block["delta"][rows] <= fit[q, rows])]
            for f in range(wide):
                out.append(np.stack([*plain[f], np.bincount(cells[f], stats[2], n_nodes * n_bins)], axis=-1).ravel())
            total = np.stack([np.bincount(seat, s, n_nodes) for s in stats], axis=-1)
            member = np.zeros((len(rows), n_nodes * 3))
            for k, s in enumerate(stats):
                member[np.arange(len(rows)), seat * 3 + k] = 1.0 if s is None else s
            ones = (hot @ member).reshape(len(hot), n_nodes, 3)
            out.append(np.stack([total - ones, ones], axis=2).ravel())
            out.append(total.ravel())
        return np.concatenate(out)

    def leaves(block: dict, fit: np.ndarray, bag: np.ndarray, trees: list[dict], seats: list[np.ndarray]) -> Iterator[tuple]:
        """Quantile, then leaf, code, residual and weight of the bag's rows; ``seats`` number the leaves."""
        for q, tree in enumerate(trees):
            residual = (block["delta"] - fit[q])[bag]
            yield q, seats[q][grow(block["bins"], tree)[bag]], codes(residual), residual, block["weight"][bag]

    def windows(groups: list[tuple], n_nodes: int, shares: list[float], spread: float, slack: float) -> list[tuple]:
        """For each quantile: ``[leaf, (weight below, weight, first, last, middle)]``, and leaf, residual and weight of the rows around the quantile.

        Rows that are left out are at most ``first`` or at least ``last``; these are infinite where none is. ``middle`` is the quantile of these groups.
        """
        out = []
        for q, share in enumerate(shares):
            at, residual, weight = (np.concatenate([g[k] for g in groups if g[0] == q]) for k in (1, 3, 4))
            order = np.lexsort((residual, at))
            at, residual, weight = at[order], residual[order], weight[order]
            ends = np.searchsorted(at, np.arange(n_nodes + 1))
            edges, kept = np.tile([0.0, 0.0, -np.inf, np.inf, 0.0], (n_nodes, 1)), []
            for leaf in range(n_nodes):
                first, last = int(ends[leaf]), int(ends[leaf + 1])
                if first == last:
                    continue
                upto = np.cumsum(weight[first:last])
                middle, half = int(np.searchsorted(upto, upto[-1] * share * slack)), int(spread * np.sqrt(len(upto) * share * (1 - share))) + 2
                low, high = max(middle - half, 0), min(middle + half, len(upto))
                edges[leaf, :2] = upto[low - 1] if low else 0.0, upto[-1]
                edges[leaf, 4] = residual[first + min(middle, len(upto) - 1)]
                if low:
                    edges[leaf, 2] = residual[first + low]
                if high < len(upto):
                    edges[leaf, 3] = residual[first + high - 1]
                kept.append(np.arange(first + low, first + high))
            rows = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            out.append((edges, at[rows], residual[rows], weight[rows]))
        return out

    def nearly(block: dict, fit: np.ndarray, bag: np.ndarray, trees: list[dict], shares: list[float], rate: float) -> np.ndarray:
        """The fit after a round whose trees are not yet fully grown, with the block's own quantiles of their nodes."""
        out = fit.copy()
        for q, tree in enumerate(trees):
            at, residual = grow(block["bins"], tree), block["delta"] - fit[q]
            order = np.flatnonzero(bag)
            order = order[np.argsort(residual[order])]
            steps = np.zeros(len(tree["feature"]))
            for node in np.unique(at).tolist():
                rows = order[at[order] == node]
                if len(rows):
                    upto = np.cumsum(block["weight"][rows])
                    steps[node] = rate * residual[rows[min(int(np.searchsorted(upto, shares[q] * upto[-1])), len(rows) - 1)]]
            out[q] += steps[at]
        return out

    def ahead(blocks: list[tuple], trees: list[dict], low: list[np.ndarray], high: list[np.ndarray], next_bag: Callable[[dict], np.ndarray], levels: list[list[dict]], wide: int, n_bins: int) -> tuple[np.ndarray, list[tuple]]:
        """Sums of the next round by ``levels``, and the rows they leave open, if the nodes add from ``low`` to ``high`` to the fit.

        An open row, by quantile: node, bins, target, fit and weight. It counts as above the fit in the sums.
        """
        total, left_open = 0.0, []
        for block, fit, _ in blocks:
            bag, delta, at = next_bag(block), block["delta"], [grow(block["bins"], tree) for tree in trees]
            least = np.stack([fit[q] + low[q][nodes] for q, nodes in enumerate(at)])
            total = total + np.stack([histograms(block, least, bag, level, wide, n_bins) for level in levels])
            for q, nodes in enumerate(at):
                rows = np.flatnonzero(bag & (delta > least[q]) & (delta <= fit[q] + high[q][nodes]))
                left_open.append((q, nodes[rows], block["bins"][:, rows], delta[rows], fit[q, rows], block["weight"][rows]))
        return total, left_open

    def counted(groups: Iterator[tuple], n_nodes: int, low: np.ndarray, width: np.uint64, cells: int) -> np.ndarray:
        """``[quantile, leaf, cell, (rows, weight)]`` of the codes from ``low`` on, cut into ``cells`` ranges of ``width``."""
        out = np.zeros((len(low), n_nodes, cells, 2))
        for q, at, code, _, weight in groups:
            inside = code >= low[q, at]
            cell = (code[inside] - low[q, at][inside]) // width
            held = cell < cells
            place = at[inside][held] * cells + cell[held].astype(np.int64)
            out[q, :, :, 0] += np.bincount(place, None, n_nodes * cells).reshape(n_nodes, cells)
            out[q, :, :, 1] += np.bincount(place, weight[inside][held], n_nodes * cells).reshape(n_nodes, cells)
        return out

    def fetched(groups: Iterator[tuple], low: np.ndarray, high: np.ndarray) -> list[tuple]:
        """Residuals and weights with codes from ``low`` to ``high``."""
        out = []
        for q, at, code, residual, weight in groups:
            keep = (code >= low[q, at]) & (code <= high[q, at])
            out.append((q, at[keep], residual[keep], weight[keep]))
        return out

    return SimpleNamespace(**{k: v for k, v in locals().items()})


def _blocks(vectors: DataFrame, thresholds: list[list[float]], block_rows: int) -> DataFrame:
    """Rows as blocks of arrays: ``(bins, row_hash, delta, weight)``, features first."""
    import pyarrow as pa

    cuts, names = [np.array(t) for t in thresholds], ["n", "bins", "row_hash", "delta", "weight"]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                flat = part.column("features").flatten().to_numpy(zero_copy_only=False)
                matrix = flat.reshape(part.num_rows, -1)
                bins = np.stack([np.searchsorted(c, matrix[:, f], "left") for f, c in enumerate(cuts)]).astype(np.uint8) if cuts else np.zeros((0, part.num_rows), np.uint8)
                arrays = [np.ascontiguousarray(bins), *[part.column(c).to_numpy(zero_copy_only=False) for c in names[2:]]]
                columns = [pa.array([part.num_rows], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]]
                yield pa.record_batch(columns, names)

    return vectors.select(vector_to_array("features").alias("features"), "row_hash", "delta", "weight").mapInArrow(
        run, "n long, bins binary, row_hash binary, delta binary, weight binary"
    )


class Booster:
    """Trees of all quantiles, level by level, over blocks."""

    packed: SimpleNamespace | None = None  # the work on packed rows
    n_measures = 3  # of a bin: rows, weight, weight below the fit; of packed rows the number by weight and side of the fit

    def __init__(self, blocks: DataFrame, n_rows: int, thresholds: list[list[float]], config: BoostingConfig, kinds: list[float] | None = None):
        """``kinds``: the distinct weights, where rows are to be packed."""
        self.n_rows = n_rows
        self.config, self.thresholds, self.kernels = config, thresholds, _kernels()
        self.wide = next((f for f in range(len(thresholds), 0, -1) if thresholds[f - 1] != [0.5]), 0)
        self.n_bins = max([len(t) + 1 for t in thresholds[: self.wide]], default=1)
        self.n_features = len(thresholds)
        self.start: list[float] = []
        self.rounds: list[list[dict]] = []
        self.guess: list[list[tuple[int, int]]] = []  # of each quantile, the likely root splits of the next round
        # The sums of the next round's roots and, of each quantile, those of the next level by likely root split.
        self.ahead: tuple[np.ndarray, list[dict[tuple, np.ndarray]]] | None = None
        self.past = None  # the broadcast rounds of the kept blocks
        self.kept: RDD | None = None
        self.kept_rounds = 0

        def unpacked(row) -> dict:
            arrays = {"row_hash": np.int64, "delta": np.float64, "weight": np.float64}
            return {"bins": np.frombuffer(row["bins"], np.uint8).reshape(-1, row["n"])} | {k: np.frombuffer(row[k], t) for k, t in arrays.items()}

        self.source = blocks.rdd.map(unpacked)
        if kinds is not None:
            self.n_measures = 2 * len(kinds)
            self.packed = packed.kernels(self.kernels, self.wide, self.n_bins, self.n_features - self.wide, kinds, len(config.quantiles))

    def close(self) -> None:
        if self.kept is not None:
            if self.packed is not None:
                self.kept.foreach(self.packed.removed)
            self.kept.unpersist()
        if self.past is not None:
            self.past.unpersist()

    def _keep(self) -> None:
        """Blocks with the fit so far, from the stored rows and all trees; packed rows are kept once, and only the trees go out again."""
        if self.packed is not None:
            if self.past is not None:
                self.past.unpersist()
            self.past, self.kept_rounds = self.source.context.broadcast(list(self.rounds)), len(self.rounds)
            if self.kept is None:
                store, name = self.packed.store, f"fit-{uuid.uuid4().hex}"
                self.kept = self.source.mapPartitionsWithIndex(lambda i, blocks: [store(i, blocks, name)]).persist(StorageLevel.MEMORY_AND_DISK)
            return
        # One task adds up in the order of the rows; sums of several depend on how rows were dealt out anyway.
        wide, prepared = (self.wide, self.kernels.prepared) if self.source.getNumPartitions() > 1 else (0, lambda b, _: b)
        fitted, start, old, old_past = self.kernels.fitted, list(self.start), self.kept, self.past
        # In the closure itself the trees would go out with each of the passes over the kept blocks.
        rounds = self.past = self.source.context.broadcast(list(self.rounds))
        self.kept = self.source.map(lambda b: prepared(b, wide) | {"fit": fitted(b, start, rounds.value)}).persist(StorageLevel.MEMORY_AND_DISK)
        self.kept_rounds = len(self.rounds)
        if old is not None:
            old.unpersist()
            old_past.unpersist()

    def _sum(self, work: Callable[[dict], np.ndarray]) -> np.ndarray:
        def all_blocks(blocks: Iterator[dict]) -> Iterator[np.ndarray]:
            total = None
            for block in blocks:
                found = work(block)
                total = found if total is None else total + found
            if total is not None:
                yield total

        # The sums of a few tasks are added up by the driver; a stage between would take longer than the work.
        return self.kept.mapPartitions(all_blocks).treeReduce(np.add, 1 if self.kept.getNumPartitions() <= _FEW_TASKS else 2)

    def _passed(self, work: Callable[[Callable[[], Iterator[tuple[dict, np.ndarray]]]], object], add: Callable | None = None) -> list:
        """What ``work`` finds in each part's packed rows with their fit, which it may go through again; added up where ``add`` is given.

        Parts whose files a task doesn't find, as after a lost executor, are worked on from the stored rows and all trees.
        """
        own, start, done, base, past, recent = self.packed, list(self.start), len(self.rounds), self.kept_rounds, self.past, self.rounds[self.kept_rounds :]
        opened, arrays_of, chunk, fitted = own.opened, own.arrays_of, own.chunk, self.kernels.fitted

        def trees(since: int) -> list[list[dict]]:
            return recent[since - base :] if since >= base else [*past.value[since:], *recent]

        def kept(handles: Iterator[tuple]) -> Iterator[tuple[list[int], list]]:
            for handle in handles:
                found = os.path.exists(handle[1])
                yield ([], [work(lambda handle=handle: opened(handle, start, done, trees))]) if found else ([handle[0]], [])

        def stored(blocks: Iterator[dict]) -> Iterator:
            every = [chunk(*c) for c in arrays_of(blocks)]
            yield work(lambda: ((b, fitted(b, start, trees(0))) for b in every))

        def both(a: tuple[list[int], list], b: tuple[list[int], list]) -> tuple[list[int], list]:
            return a[0] + b[0], [add(*a[1], *b[1])] if a[1] and b[1] else a[1] + b[1]

        parts = self.kept.mapPartitions(kept)
        if add is not None and parts.getNumPartitions() > _FEW_TASKS:
            parts = [parts.treeReduce(both)]
        else:
            parts = parts.collect()
        lost, found = [i for p in parts for i in p[0]], [f for p in parts for f in p[1]]
        if lost:
            found += self.source.context.runJob(self.source.mapPartitions(stored), lambda rows: rows, lost)
        return found if add is None else [functools.reduce(add, found)]

    def _with_fit(self, number: int | None) -> Callable[[dict], tuple[np.ndarray, np.ndarray]]:
        """Of a block: the fit before the round, and the round's bag."""
        since, config, kernels = self.rounds[self.kept_rounds :], self.config, self.kernels
        seed, share = config.seed, config.subsample if number is not None else 1.0
        advanced, bagged = kernels.advanced, kernels.bagged
        return lambda b: (advanced(b, b["fit"], since), bagged(b, number or 0, seed, share))

    def _measured(self, sums: np.ndarray) -> np.ndarray:
        """``[..., (rows, weight, weight below the fit)]``."""
        if self.packed is None:
            return sums
        by_kind = sums.reshape(*sums.shape[:-1], -1, 2)
        return np.stack([sums.sum(axis=-1), by_kind.sum(axis=-1) @ self.packed.weights, by_kind[..., 1] @ self.packed.weights], axis=-1)

    def _gains(self, sums: tuple[np.ndarray, np.ndarray], q: float) -> tuple[float, list[tuple[int, np.ndarray]]]:
        """The score of a node and, by first feature, that of its splits; ``sums`` are by feature, the wide ones and the tags."""
        whole, least = (sums[0] if len(sums[0]) else sums[1])[0].sum(axis=0), self.config.min_leaf_rows
        total = self._measured(whole)
        gradient = q * total[1] - total[2]
        found = []
        for start, own in ((0, sums[0]), (self.wide, sums[1])):
            left = np.cumsum(own, axis=1)[:, :-1]
            left, right = self._measured(left), self._measured(whole - left)
            fits = np.minimum(left[..., 0], right[..., 0]) >= max(least, 1)
            if fits.any():
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = [(q * s[..., 1] - s[..., 2]) * (q * s[..., 1] - s[..., 2]) / s[..., 1] for s in (left, right)]
                found.append((start, np.where(fits, gains[0] + gains[1], -np.inf)))
        return gradient * gradient / total[1] if total[1] > 0 else 0.0, found

    def _split(self, sums: tuple[np.ndarray, np.ndarray], q: float) -> tuple[int, int] | None:
        """Feature and bin of the best split of a node; the first of equal ones."""
        best, by_group = self._gains(sums, q)
        found = None
        for start, gain in by_group:
            f, at = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[f, at] > best:
                best, found = float(gain[f, at]), (start + int(f), int(at))
        return found

    def _likely(self, sums: tuple[np.ndarray, np.ndarray], q: float) -> list[tuple[int, int]]:
        """Some of the best splits of a node."""
        least, by_group = self._gains(sums, q)
        best = []
        for start, gain in by_group:
            for place in np.argsort(-gain, axis=None, kind="stable")[:_GUESSES]:
                f, at = np.unravel_index(place, gain.shape)
                if gain[f, at] > least:
                    best.append((float(gain[f, at]), (start + int(f), int(at))))
        return [split for _, split in sorted(best, key=lambda b: -b[0])[:_GUESSES]]

    def _by_feature(self, own: np.ndarray, n_nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """The sums of a quantile's nodes as ``[feature, node, bin, measure]``: the wide features, then the tags."""
        m = self.n_measures
        split, narrow = self.wide * n_nodes * self.n_bins * m, self.n_features - self.wide
        tags = own[split : split + narrow * n_nodes * 2 * m].reshape(narrow, n_nodes, 2, m)
        return own[:split].reshape(self.wide, n_nodes, self.n_bins, m), tags

    def _few_tasks(self) -> bool:
        """Whether all blocks are in so few tasks that one pass gives the leaf values."""
        tasks = self.kept.getNumPartitions()
        return tasks <= _FEW_TASKS and self._sent(tasks) <= _FETCHED

    def _sent(self, tasks: int) -> float:
        """How many residuals around the leaves' quantiles so many tasks send about."""
        size = 2**self.config.max_depth
        return sum(2 * (_SPREAD * np.sqrt(self.n_rows * size / tasks * q * (1 - q)) + 2 * size) for q in self.config.quantiles) * tasks

    def _with_guesses(self, now: list[dict], number: int) -> np.ndarray:
        """The sums of the last level; the pass also names the likely root splits of the next round."""
        with_fit, config, wide, n_bins, n_q = self._with_fit(number), self.config, self.wide, self.n_bins, len(now)
        histograms, nearly, bagged = self.kernels.histograms, self.kernels.nearly, self.kernels.bagged
        rate, seed, share, shares = config.learning_rate, config.seed, config.subsample, list(config.quantiles)
        roots = [{"feature": np.full(1, -1), "cut": np.zeros(1, np.int64), "levels": 0}] * n_q

        def work(block: dict) -> np.ndarray:
            fit, bag = with_fit(block)
            later = nearly(block, fit, bag, now, shares, rate), bagged(block, number + 1, seed, share)
            return np.concatenate([histograms(block, fit, bag, now, wide, n_bins), histograms(block, *later, roots, wide, n_bins)])

        sums = self._sum(work)
        held = n_q * 3 * (wide * n_bins + 2 * (self.n_features - wide) + 1)  # of the roots
        nodes = [[group[:, 0] for group in self._by_feature(own, 1)] for own in sums[len(sums) - held :].reshape(n_q, -1)]
        self.guess = [self._likely(node, q) for node, q in zip(nodes, shares)]
        return sums[: len(sums) - held]

    def _next_levels(self) -> list[list[dict]]:
        """The roots of the next round and, by likely split, the level after them."""
        n_q, size, guess = len(self.config.quantiles), 2 ** (self.config.max_depth + 1) - 1, self.guess
        levels = [[{"feature": np.full(size, -1), "cut": np.zeros(size, np.int64), "levels": 0} for _ in range(n_q)]]
        for k in range(max(map(len, guess), default=0)):
            trees = [{"feature": np.full(size, -1), "cut": np.zeros(size, np.int64), "levels": 1} for _ in range(n_q)]
            for tree, splits in zip(trees, guess):
                if k < len(splits):
                    tree["feature"][0], tree["cut"][0] = splits[k]
            levels.append(trees)
        return levels

    def _settle(self, parts: list[tuple[np.ndarray, list[tuple]]], levels: list[list[dict]], steps: list[np.ndarray]) -> None:
        """Sums of the next round, now that it is known what the nodes add to the fit: open rows are added where they lie below."""
        sums = np.sum([p[0] for p in parts], axis=0).reshape(len(levels), len(steps), -1)
        for q, step in enumerate(steps):
            own = [r for p in parts for r in p[1] if r[0] == q]
            at, delta, fit, weight = (np.concatenate([r[k] for r in own]) for k in (1, 3, 4, 5))
            below = np.flatnonzero(delta <= fit + step[at])
            if len(below):
                nothing = np.zeros(len(below))
                block = {"bins": np.concatenate([r[2] for r in own], axis=1)[:, below], "weight": weight[below], "delta": nothing}
                for k, trees in enumerate(levels):
                    found = self.kernels.histograms(self.kernels.prepared(block, self.wide), nothing[None], nothing == 0, [trees[q]], self.wide, self.n_bins)
                    sums[k, q].reshape(-1, 3)[:, 2] += found.reshape(-1, 3)[:, 2]
        children = [{split: sums[1 + k, q] for k, split in enumerate(splits)} for q, splits in enumerate(self.guess or [[]] * len(steps))]
        self.ahead = sums[0], children

    def _grow(self, number: int) -> list[dict]:
        config, n_q = self.config, len(self.config.quantiles)
        size = 2 ** (config.max_depth + 1) - 1
        trees = [{"feature": np.full(size, -1), "cut": np.zeros(size, np.int64), "levels": 0} for _ in range(n_q)]
        with_fit, histograms, wide, n_bins = self._with_fit(number), self.kernels.histograms, self.wide, self.n_bins
        (roots, ahead), self.ahead, self.guess = self.ahead or (None, []), None, []
        last = config.max_depth - 1 if self.packed is None and number + 1 < config.rounds and self.n_features and self._few_tasks() else 0
        parents: list[dict[int, list[np.ndarray]]] = [{} for _ in range(n_q)]
        for level in range(config.max_depth):
            if level and not any(parents):
                break
            now = [{"feature": t["feature"], "cut": t["cut"], "levels": level} for t in trees]
            chosen = [(int(t["feature"][0]), int(t["cut"][0])) if p else None for p, t in zip(parents, trees)]
            if level == 0 and roots is not None:
                flat = roots
            elif level == 1 and ahead and all(split is None or split in a for split, a in zip(chosen, ahead)):
                flat = np.stack([np.zeros_like(flat[q]) if split is None else ahead[q][split] for q, split in enumerate(chosen)])
            elif level and level == last:
                flat = self._with_guesses(now, number)
            elif self.packed is not None:
                flat = self._packed_level(now, number)
            else:
                flat = self._sum(lambda b: histograms(b, *with_fit(b), now, wide, n_bins))
            n_nodes = max(1, 2 ** (level - 1))
            flat = flat.reshape(n_q, -1)
            first = 2**level - 1
            for q, tree in enumerate(trees):
                by_feature = self._by_feature(flat[q], n_nodes)
                found: dict[int, list[np.ndarray]] = {}
                if level == 0:
                    found[0] = [group[:, 0] for group in by_feature]
                for node, whole in parents[q].items():
                    left, seat = 2 * node + 1, (2 * node + 1 - first) // 2
                    found[left] = [group[:, seat] for group in by_feature]
                    found[left + 1] = [w - group for w, group in zip(whole, found[left])]
                parents[q] = {}
                for node, sums in found.items():
                    split = self._split(sums, config.quantiles[q]) if self.n_features else None
                    if split:
                        tree["feature"][node], tree["cut"][node] = split
                        parents[q][node] = sums
                tree["levels"] = level + 1
        return trees

    def _bag(self, number: int | None) -> Callable[[dict], np.ndarray]:
        bagged, seed, share = self.kernels.bagged, self.config.seed, self.config.subsample if number is not None else 1.0
        return lambda b: bagged(b, number or 0, seed, share)

    def _packed_level(self, trees: list[dict], number: int) -> np.ndarray:
        level, bag = self.packed.level, self._bag(number)
        return self._passed(lambda chunks: level(chunks(), bag, trees), np.add)[0]

    def _quantiles(self, trees: list[dict], number: int | None) -> list[np.ndarray]:
        """The exact weighted quantile of the residuals in each leaf, of the target itself where there is no round yet."""
        config, kernels, with_fit = self.config, self.kernels, self._with_fit(number)
        seats = [np.cumsum(t["feature"] < 0) - 1 for t in trees]
        n_q, size, shares = len(trees), 1 + max(int(s[-1]) for s in seats), np.array(config.quantiles)[:, None]
        low, high = np.zeros((n_q, size), np.uint64), np.full((n_q, size), 2**64 - 1, np.uint64)
        width, cells = np.uint64(1 << 52), _CELLS
        want, before = None, np.zeros((n_q, size))
        leaves, counted, fetched = kernels.leaves, kernels.counted, kernels.fetched
        if self.packed is not None:
            weights, bag = self.packed.weights, self._bag(number)

            def groups(chunks: Iterator[tuple[dict, np.ndarray]]) -> Iterator[Iterator[tuple]]:
                return (leaves(b | {"weight": weights[b["kind"]]}, fit, bag(b), trees, seats) for b, fit in chunks)

        while want is None and self.n_rows * n_q > _FETCHED or want is not None and left.sum() > _FETCHED:
            if want is not None:
                if width == 1:  # many equal residuals: the code says which
                    return [kernels.decoded(low[q])[seats[q]] for q in range(n_q)]
                finer = max(width >> np.uint64(12), np.uint64(1))
                cells, width = int(width // finer), finer
            bounds = (size, low, width, cells)
            if self.packed is None:
                sums = self._sum(lambda b: counted(leaves(b, *with_fit(b), trees, seats), *bounds))
            else:
                sums = self._passed(lambda chunks: sum(counted(g, *bounds) for g in groups(chunks())), np.add)[0]
            upto = before[:, :, None] + np.cumsum(sums[..., 1], axis=2)
            if want is None:
                want = upto[:, :, -1] * shares * _SLACK
            # Where sums by another order of addition miss the last cell with rows, it is that cell.
            last = cells - 1 - np.argmax(sums[:, :, ::-1, 0] > 0, axis=2)
            reached = upto >= want[:, :, None]
            cell = np.where(reached.any(axis=2), np.minimum(np.argmax(reached, axis=2), last), last)[:, :, None]
            before = np.take_along_axis(upto - sums[..., 1], cell, axis=2)[:, :, 0]
            left = np.take_along_axis(sums[..., 0], cell, axis=2)[:, :, 0]
            low = low + cell[:, :, 0].astype(np.uint64) * width
            high = low + (width - np.uint64(1))
        parts, levels = [], []
        if self.packed is None and want is None and number is not None and self._few_tasks():
            parts, levels = self._around(trees, number, seats, size, lambda groups: fetched(groups, low, high))
            rows = [r for p in parts for r in p[2]]
        elif self.packed is None:
            rows = self.kept.flatMap(lambda b: fetched(leaves(b, *with_fit(b), trees, seats), low, high)).collect()
        else:
            rows = [r for part in self._passed(lambda chunks: [r for g in groups(chunks()) for r in fetched(g, low, high)]) for r in part]
        values, later = [], [p[1] for p in parts if p[1]]
        for q in range(n_q):
            at, residual, weight = (np.concatenate([r[k] for r in rows if r[0] == q]) for k in (1, 2, 3))
            order = np.lexsort((residual, at))
            at, residual, weight = at[order], residual[order], weight[order]
            own = np.zeros(size)
            for leaf in np.unique(at):
                span = slice(*np.searchsorted(at, [leaf, leaf + 1]))
                upto = before[q, leaf] + np.cumsum(weight[span])
                wanted = upto[-1] * config.quantiles[q] * _SLACK if want is None else want[q, leaf]
                own[leaf] = residual[span][min(int(np.searchsorted(upto, wanted)), len(upto) - 1)]
                if later and not self._bounded([p[0][q][0][leaf] for p in parts], own[leaf]):
                    later = []
            values.append(own[seats[q]])
        if later:
            self._settle(later, levels, [config.learning_rate * v for v in values])
        return values

    def _bounded(self, edges: list[np.ndarray], value: float) -> bool:
        """Whether a leaf value is what the tasks took it to be when they summed up the next round."""
        if len(edges) == 1 and self.kept.getNumPartitions() == 1:
            return value == edges[0][4]  # else sums of weights were added up in another order
        return max(e[2] for e in edges) < value < min(e[3] for e in edges)

    def _around(self, trees: list[dict], number: int, seats: list[np.ndarray], size: int, more: Callable | None = None) -> tuple[list[tuple], list[list[dict]]]:
        """Of each task the residuals around its own quantiles, the sums of the next round by the levels returned, and what ``more`` gives."""
        config, with_fit, shares, spread, slack = self.config, self._with_fit(number), list(self.config.quantiles), _SPREAD, _SLACK
        leaves, windows, ahead, bagged = self.kernels.leaves, self.kernels.windows, self.kernels.ahead, self.kernels.bagged
        rate, seed, share, wide, n_bins = config.learning_rate, config.seed, config.subsample, self.wide, self.n_bins
        levels = self._next_levels() if number + 1 < config.rounds and any(self.guess) else []
        alone = self.kept.getNumPartitions() == 1

        def run(blocks: Iterator[tuple]) -> Iterator[tuple]:
            blocks = [(b, *with_fit(b)) for b in blocks]
            groups = [g for b in blocks for g in leaves(*b, trees, seats)]
            if groups:
                found = windows(groups, size, shares, spread, slack)
                # A task with all blocks knows the leaf values.
                low, high = ([rate * w[0][s, 4 if alone else k] for w, s in zip(found, seats)] for k in (2, 3))
                yield found, levels and ahead(blocks, trees, low, high, lambda b: bagged(b, number + 1, seed, share), levels, wide, n_bins), more and more(groups)

        return self.kept.mapPartitions(run).collect(), levels

    def _one_pass(self, trees: list[dict], number: int) -> list[np.ndarray] | None:
        """What ``_quantiles`` gives, from one pass, which takes along the sums of the next round; None where it can't be told so."""
        if self.packed is not None:
            return self._packed_values(trees, number)
        if not self._few_tasks():
            return None
        shares, rate = self.config.quantiles, self.config.learning_rate
        seats = [np.cumsum(t["feature"] < 0) - 1 for t in trees]
        size, alone = 1 + max(int(s[-1]) for s in seats), self.kept.getNumPartitions() == 1
        parts, levels = self._around(trees, number, seats, size)
        later, parts = [p[1] for p in parts if p[1]], [p[0] for p in parts]
        values = []
        for q, seat in enumerate(seats):
            edges = np.stack([found[q][0] for found in parts])
            at, residual, weight = (np.concatenate([found[q][k] for found in parts]) for k in (1, 2, 3))
            order = np.lexsort((residual, at))
            at, residual, weight = at[order], residual[order], weight[order]
            own = np.zeros(size)
            for leaf in np.unique(at):
                span = slice(*np.searchsorted(at, [leaf, leaf + 1]))
                upto = edges[:, leaf, 0].sum() + np.cumsum(weight[span])
                reached = int(np.searchsorted(upto, edges[:, leaf, 1].sum() * shares[q] * _SLACK))
                if reached == len(upto):
                    return None
                own[leaf] = residual[span][reached]
                # Then what the tasks left out is on the side where they counted it.
                if not (edges[:, leaf, 2].max() < own[leaf] < edges[:, leaf, 3].min()):
                    return None
            values.append(own[seat])
            if alone and (own != parts[0][q][0][:, 4]).any():  # sums of weights by another order of addition
                later = []
        if later:
            self._settle(later, levels, [rate * v for v in values])
        return values

    def _packed_values(self, trees: list[dict], number: int) -> list[np.ndarray] | None:
        """What ``_quantiles`` gives, from one pass over packed rows; None where it can't be told so."""
        if self._sent(self.kept.getNumPartitions()) > _AROUND:
            return None
        windows, ahead, bag, next_bag = self.packed.windows, self.packed.ahead, self._bag(number), self._bag(number + 1)
        weights, shares, spread, slack, rate = self.packed.weights, list(self.config.quantiles), _SPREAD, _SLACK, self.config.learning_rate
        seats = [np.cumsum(t["feature"] < 0) - 1 for t in trees]
        roots = [{"feature": np.full(1, -1), "cut": np.zeros(1, np.int64), "levels": 0}] * len(trees) if number + 1 < self.config.rounds else []

        def work(chunks: Callable[[], Iterator]) -> tuple | None:
            found = windows(chunks(), bag, trees, seats, shares, spread, slack)
            return found and (found, roots and ahead(chunks, found, next_bag, trees, seats, rate, roots))

        later, parts = [], [p for p in self._passed(work) if p]
        if roots:
            later = [p[1] for p in parts]
        parts = [p[0] for p in parts]
        values = []
        for q, seat in enumerate(seats):
            under, whole = (np.sum([p[q][k] for p in parts], axis=0) for k in (0, 1))
            edges = np.stack([p[q][2] for p in parts])
            first, last = edges[:, :, 0].max(axis=0), edges[:, :, 1].min(axis=0)
            at, residual, alike = (np.concatenate([p[q][k] for p in parts]) for k in (3, 4, 5))
            order = np.argsort(residual)
            order = order[np.argsort(at[order], kind="stable")]
            at, residual, alike = at[order], residual[order], alike[order]
            ends = np.searchsorted(at, np.arange(len(whole) + 1))
            own = np.zeros(len(whole))
            for leaf in np.flatnonzero(whole.sum(axis=1)):
                span = slice(ends[leaf], ends[leaf + 1])
                upto = (under[leaf] + np.cumsum(alike[span], axis=0)) @ weights
                reached = int(np.searchsorted(upto, whole[leaf] @ weights * shares[q] * _SLACK))
                if reached == len(upto) or not first[leaf] <= residual[span][reached] <= last[leaf]:
                    return None
                own[leaf] = residual[span][reached]
            values.append(own[seat])
        if later:
            sums = np.sum([sums for sums, _ in later], axis=0).reshape(len(values), -1)
            for q, own in enumerate(values):
                self.packed.settled(sums[q], [r for _, left_open in later for r in left_open[q]], rate * own)
            self.ahead = sums, []
        return values

    def run(self) -> None:
        config = self.config
        root = {"feature": np.full(1, -1), "cut": np.zeros(1, np.int64), "levels": 0}
        self.start = [0.0] * len(config.quantiles)
        self._keep()
        self.start = [float(v[0]) for v in self._quantiles([root] * len(config.quantiles), None)]
        for number in range(config.rounds):
            if number % _KEPT_ROUNDS == 0:
                self._keep()
            trees = self._grow(number)
            found = self._one_pass(trees, number)
            for tree, values in zip(trees, self._quantiles(trees, number) if found is None else found):
                tree["leaf"] = values
                tree["value"] = config.learning_rate * values
            self.rounds.append(trees)

    def tree(self, packed: dict) -> dict:
        """A tree as parallel arrays, numbered as its rows are read: node, left part, right part."""
        out = {"feature": [], "threshold": [], "left": [], "right": [], "value": []}

        def add(node: int) -> int:
            at, f = len(out["feature"]), int(packed["feature"][node])
            for name, value in (("feature", f), ("threshold", 0.0), ("left", at), ("right", at), ("value", 0.0)):
                out[name].append(value)
            if f < 0:
                out["value"][at] = float(packed["leaf"][node])
            else:
                out["threshold"][at] = float(self.thresholds[f][packed["cut"][node]])
                out["left"][at] = add(2 * node + 1)
                out["right"][at] = add(2 * node + 2)
            return at

        add(0)
        return out


def _kinds(vectors: DataFrame) -> list[float] | None:
    """The distinct weights, least first, if they are few; None otherwise."""
    found = [r["weight"] for r in vectors.select("weight").distinct().limit(packed.MOST_KINDS + 1).collect()]
    return sorted(found) if len(found) <= packed.MOST_KINDS and all(w is not None and np.isfinite(w) for w in found) else None


def boost(vectors: DataFrame, thresholds: list[list[float]], config: BoostingConfig) -> tuple[dict[float, float], dict[float, list[dict]]]:
    """``(starts, trees)`` of all quantiles from stored rows ``features, delta, weight, row_hash``."""
    spark = vectors.sparkSession
    n_rows = vectors.count()
    # A task for each block while there are cores for them, then for each few blocks, up to some tasks for each core.
    blocks, cores = -(-n_rows // BLOCK_ROWS), spark.sparkContext.defaultParallelism
    kinds = _kinds(vectors) if n_rows > packed.CHUNK_ROWS and thresholds else None
    if kinds is None:
        tasks = max(1, min(blocks, max(cores, -(-blocks // _TASK_BLOCKS)), 8 * cores))
    else:  # packed rows take little time
        tasks = min(-(-n_rows // packed.CHUNK_ROWS), max(cores, -(-n_rows // _PART_ROWS)), 8 * cores)
    dealt = _blocks(vectors.repartition(tasks), thresholds, BLOCK_ROWS)
    if kinds is None:
        path = new_path(spark, "model-blocks")
        dealt.write.parquet(path)
        dealt = spark.read.parquet(path)
    booster = Booster(dealt, n_rows, thresholds, config, kinds)
    try:
        booster.run()
    finally:
        booster.close()
    starts = dict(zip(config.quantiles, booster.start))
    return starts, {q: [booster.tree(of_round[i]) for of_round in booster.rounds] for i, q in enumerate(config.quantiles)}


def sides(panel: DataFrame, config: BoostingConfig = BoostingConfig(), split: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: the model's rows, written once."""
    rows = model_rows(panel)
    split = group_split(rows, share=config.test_share, seed=config.seed) if split is None else split
    path = new_path(panel.sparkSession, "model-rows")
    apply_split(rows, split).write.parquet(path)
    stored = panel.sparkSession.read.parquet(path)
    return stored.filter("not is_test"), stored.filter("is_test")


def learn(train: DataFrame, vocabulary: dict[str, list[str]], config: BoostingConfig = BoostingConfig()) -> QuantileModel:
    """The model of stored training rows."""
    if train.isEmpty():
        raise ValueError("There are no training rows.")
    features = usable_features(train)
    model = QuantileModel(features, fit_medians(train, features), vocabulary, config.learning_rate)
    vectors = feature_vector(train, model).select(
        F.xxhash64("app_id", "k_index").alias("row_hash"),
        "features",
        "delta",
        sample_weight(F.col(params.DOWNTREND_FEATURE)).alias("weight"),
    )
    path = new_path(train.sparkSession, "model-vectors")
    vectors.write.parquet(path)
    filled = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(model.medians[c])).alias(c) for c in features])
    cuts = learned_thresholds(filled, features, config.max_bins)
    tags = len(model.feature_names) - len(features)
    thresholds = [cuts[c] for c in features] + [[0.5]] * tags
    model.start, model.trees = boost(train.sparkSession.read.parquet(path), thresholds, config)
    return model


def fit(panel: DataFrame, vocabulary: dict[str, list[str]], config: BoostingConfig = BoostingConfig(),
        split: DataFrame | None = None) -> tuple[QuantileModel, DataFrame, DataFrame]:
    """Fit all quantiles: ``(model, train rows, test rows)``."""
    train, test = sides(panel, config, split)
    return learn(train, vocabulary, config), train, test


def column_name(q: float) -> str:
    return f"delta_q{round(q * 100):02d}"


def tree_evaluator(model: QuantileModel) -> Callable[[Iterator[pd.Series]], Iterator[pd.DataFrame]]:
    """Batches of feature arrays to one predicted log change per quantile.

    The result refers to numpy and pandas only, so workers need not have this package.
    The model is a few hundred small trees, fixed by the number of rounds.
    """
    quantiles = sorted(model.trees)
    steps = {q: [(_splits(t), np.asarray(t["value"], float), np.min_scalar_type(-len(t["value"]) - 1)) for t in model.trees[q]] for q in quantiles}
    starts, rate = dict(model.start), model.learning_rate
    names = {q: column_name(q) for q in quantiles}

    def forecast(columns: np.ndarray, q: float) -> np.ndarray:
        total = np.zeros(columns.shape[1])
        for splits, value, kind in steps[q]:
            at = np.zeros(columns.shape[1], kind)
            # Node by node, parents first: comparing a whole column takes a fraction of looking up a value for each row.
            for node, feature, threshold, left, right in splits:
                at += (at == node) * (kind.type(right - node) - (columns[feature] <= threshold) * kind.type(right - left))
            total += value[at]
        return starts[q] + rate * total

    def evaluate(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = np.ascontiguousarray(np.stack(batch.to_numpy()).T) if len(batch) else None
            yield pd.DataFrame({names[q]: np.zeros(0) if columns is None else forecast(columns, q) for q in quantiles})

    return evaluate


def predict(rows: DataFrame, model: QuantileModel) -> DataFrame:
    """Add one predicted log change per quantile, evaluated in Arrow batches. Crossing is left as it is."""
    returns = ", ".join(f"{column_name(q)} double" for q in sorted(model.trees))
    apply = F.pandas_udf(tree_evaluator(model), returns)
    vectored = feature_vector(rows, model, "_features")
    keyed = vectored.withColumn("_predicted", apply(vector_to_array("_features")))
    return keyed.select(*rows.columns, "_predicted.*")


def _splits(tree: dict, at: int = 0) -> list[tuple]:
    """Node, feature, threshold, left and right child of each split, parents first."""
    left, right = int(tree["left"][at]), int(tree["right"][at])
    if left == at:
        return []
    return [(at, int(tree["feature"][at]), float(tree["threshold"][at]), left, right), *_splits(tree, left), *_splits(tree, right)]


TREE_SCHEMA = (
    "quantile double, round int, feature array<int>, threshold array<double>, "
    "left array<int>, right array<int>, value array<double>"
)
HEADER_SCHEMA = (
    "quantile double, start double, learning_rate double, features array<string>, medians map<string,double>, "
    "genre_vocab array<string>, cat_vocab array<string>, target string, "
    "weight_feature string, weight_threshold double, weight_multiplier double"
)


def save_model(spark: SparkSession, model: QuantileModel, path: str) -> None:
    """Store the model as two small tables: trees and header."""
    trees = [
        (q, number, t["feature"], t["threshold"], t["left"], t["right"], t["value"])
        for q, all_trees in model.trees.items()
        for number, t in enumerate(all_trees)
    ]
    header = [
        (
            q, model.start[q], model.learning_rate, model.features, model.medians,
            model.vocabulary.get("genre", []), model.vocabulary.get("category", []),
            "delta = y_log_avg - ln(avg_k)",
            params.DOWNTREND_FEATURE, params.DOWNTREND_THRESHOLD, params.DOWNTREND_WEIGHT,
        )
        for q in model.trees
    ]
    spark.createDataFrame(trees, TREE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    spark.createDataFrame(header, HEADER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/header")


def load_model(spark: SparkSession, path: str) -> QuantileModel:
    header = spark.read.schema(HEADER_SCHEMA).parquet(f"{path}/header").collect()
    first = header[0]
    model = QuantileModel(
        list(first["features"]), dict(first["medians"]),
        {"genre": list(first["genre_vocab"]), "category": list(first["cat_vocab"])}, first["learning_rate"],
        {r["quantile"]: r["start"] for r in header},
    )
    for row in spark.read.schema(TREE_SCHEMA).parquet(f"{path}/trees").orderBy("quantile", "round").collect():
        tree = {k: list(row[k]) for k in ("feature", "threshold", "left", "right", "value")}
        model.trees.setdefault(row["quantile"], []).append(tree)
    return model
