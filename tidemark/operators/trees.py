"""Tree ensembles grown from histograms, many models at once: boosted trees with an L2 leaf penalty, and random forests.

Columns are binned once: numbers at up to ``BINS`` quantiles, categories by value. A split of a number is "at most this
bin", of a category "this value". What each model fills in for missing values (medians and modes of its own training rows)
differs from fold to fold, so missing values keep a bin of their own, which every model adds to the bin of its own fill.

Boosting: one job a tree level adds up gradients and curvatures by (model, node, bin) for all folds and the final model
together; the best split is found on these sums, whose size depends on the models and not on the rows. A leaf is
``G / (H + l2)`` times the step. Rows keep their margins, renewed every ``REFRESH`` rounds.

Forests: a tree's row counts are Poisson numbers of (tree, row key), class weights are computed inside each bootstrap. A
level of many trees is one job too; a node of at most ``LOCAL_ROWS`` rows is sent to one task, which grows the rest of its tree
in the same way. Trees have no depth limit unless one is given, so they grow with the rows over ``min_rows``.

The blocks of binned rows are written to the shared folder; RDDs are used here alone, as each step is numpy work on a block.
All random numbers are hashes of seeds, trees and row keys, never of partitions.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from typing import Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_path, settle

BINS = 64
BLOCK_ROWS = 50_000
LOCAL_ROWS = 50_000
SCORE_ROWS = 50_000  # rows that are sent down the trees together
JOBS_A_TASK = 32  # trees of a forest that one task grows
TASK_ROWS = 200_000  # rows of a table that one task boosts by itself
REFRESH = 10
HISTOGRAM_CELLS = 4_000_000  # cells that one job of a forest adds up
LEAST_GAIN = 1e-6


# --- columns and fills ------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Layout:
    """The binned columns of a training table, numbers first."""

    numeric: list[str]
    categorical: list[str]
    cuts: list[list[float]]  # upper bin limits of each number
    values: list[list[str]]  # known values of each category

    @property
    def bins(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts] + [len(v) for v in self.values], np.int64)

    @property
    def offsets(self) -> np.ndarray:
        """First slot of each column; the slot behind a column's bins holds its missing values."""
        return np.concatenate(([0], np.cumsum(self.bins + 1)))

    def codes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Bin of every value: rows by columns. A missing value has the last bin; an unknown category is -1 and equals no value."""
        out = np.empty((len(columns[0]), len(columns)), np.int32)
        for i, cuts in enumerate(self.cuts):
            x = columns[i].astype(np.float64)
            out[:, i] = np.where(np.isnan(x), len(cuts) + 1, np.searchsorted(cuts, x, side="left"))
        for i, values in enumerate(self.values, start=len(self.cuts)):
            known = {v: k for k, v in enumerate(values)}
            out[:, i] = [len(values) if v is None else known.get(v, -1) for v in columns[i]]
        return out


@dataclass(frozen=True)
class Fills:
    """What a model puts for missing values."""

    medians: dict[str, float]
    modes: dict[str, str]

    def bins(self, layout: Layout) -> np.ndarray:
        numbers = [int(np.searchsorted(cuts, self.medians.get(c, 0.0), side="left")) for c, cuts in zip(layout.numeric, layout.cuts)]
        kinds = [values.index(self.modes[c]) if self.modes.get(c) in values else len(values)
                 for c, values in zip(layout.categorical, layout.values)]
        return np.array(numbers + kinds, np.int64)


def inputs_of(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> list:
    return [F.col(f"`{c}`").cast("double").alias(c) for c in numeric] + [F.col(f"`{c}`").cast("string").alias(c) for c in categorical]


def learn_layout(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = BINS) -> Layout:
    """Quantiles of the numbers and values of the categories; bin limits and known values come to the driver."""
    shares = [i / bins for i in range(1, bins)]
    cuts = []
    if numeric:
        row = train.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 10_000).alias(f"c{i}") for i, c in enumerate(numeric)]).first()
        cuts = [sorted(set(found or [])) for found in row]
    values: dict[str, list[str]] = {c: [] for c in categorical}
    if categorical:
        long = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in categorical])).alias("x"))
        for r in long.select("x.*").where("v IS NOT NULL").distinct().collect():
            values[r["c"]].append(r["v"])
    return Layout(list(numeric), list(categorical), cuts, [sorted(values[c]) for c in categorical])


# --- trees ------------------------------------------------------------------------------------------------------------

NODE_PARTS = ("column", "bin", "missing", "left", "right", "value", "cover")


@dataclass
class Tree:
    """Nodes of one tree; ``column`` is -1 at a leaf, ``missing`` tells whether a missing value goes left."""

    column: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    missing: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    path: list[int] = field(default_factory=lambda: [1])

    def add(self, value: float, cover: float, path: int) -> int:
        for held, x in ((self.column, -1), (self.bin, 0), (self.missing, False), (self.left, 0), (self.right, 0), (self.value, value),
                        (self.cover, cover), (self.path, path)):
            held.append(x)
        return len(self.column) - 1

    def pack(self) -> bytes:
        """The finished tree as few bytes: 25 a node before compression."""
        kinds = (np.int16, np.int16, bool, np.int32, np.int32, np.float64, np.float64)
        return zlib.compress(pickle.dumps([np.asarray(getattr(self, c), k) for c, k in zip(NODE_PARTS, kinds)], 5), 1)

    def bare(self) -> Tree:
        """Without covers, and without the values of nodes that are split."""
        value = np.where(np.asarray(self.column) < 0, self.value, 0.0)
        return replace(self, value=value, cover=np.zeros(len(value)))

    @classmethod
    def unpack(cls, held: bytes) -> Tree:
        return cls(*pickle.loads(zlib.decompress(held)), path=[])

    def graft(self, at: int, other: Tree) -> None:
        """Put ``other`` in the place of leaf ``at``."""
        places = [at, *range(len(self.column), len(self.column) + len(other.column) - 1)]
        for _ in other.column[1:]:
            self.add(0.0, 0.0, 0)
        for i, to in enumerate(places):
            self.column[to], self.bin[to], self.missing[to] = other.column[i], other.bin[i], other.missing[i]
            self.left[to], self.right[to] = places[other.left[i]], places[other.right[i]]
            self.value[to], self.cover[to] = other.value[i], other.cover[i]


@dataclass(frozen=True)
class HeldTrees(Sequence):
    """Trees in packed form, unpacked one at a time."""

    packed: list[bytes]

    def __len__(self) -> int:
        return len(self.packed)

    def __getitem__(self, i: int) -> Tree:
        return Tree.unpack(self.packed[i])


@dataclass(frozen=True)
class StoredTrees(Sequence):
    """The trees of one model in a written table (model, tree, packed). They come to the driver in packed form, when asked for."""

    path: str
    model: int
    count: int

    def rows(self) -> DataFrame:
        return SparkSession.active().read.schema(TREE_ROWS).parquet(self.path).where(F.col("model") == self.model)

    def held(self, bare: bool = False) -> HeldTrees:
        """The trees, a part of the table at a time; ``bare``: with the values of the leaves only, which is what scoring reads."""
        def stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                small = [Tree.unpack(x).bare().pack() for x in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(small, pa.binary())], names=b.schema.names)

        rows = self.rows().mapInArrow(stripped, TREE_ROWS) if bare else self.rows()
        found = {r["tree"]: bytes(r["packed"]) for r in rows.toLocalIterator()}
        return HeldTrees([found[i] for i in sorted(found)])

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> Tree:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return Tree.unpack(bytes(self.rows().where(F.col("tree") == i).first()["packed"]))

    def __iter__(self) -> Iterator[Tree]:
        return iter(self.held())


TREE_ROWS = "model int, tree int, packed binary"


def tree_rows(trees: Sequence[Tree]) -> DataFrame:
    """Trees as the rows of a written table."""
    if isinstance(trees, StoredTrees):
        return trees.rows().withColumn("model", F.lit(0))
    packed = trees.packed if isinstance(trees, HeldTrees) else [t.pack() for t in trees]
    return SparkSession.active().createDataFrame([(0, i, bytearray(b)) for i, b in enumerate(packed)], TREE_ROWS)


class Router:
    """A tree as arrays, to send binned rows down."""

    def __init__(self, tree: Tree, layout: Layout) -> None:
        self.column, self.bin = np.array(tree.column), np.array(tree.bin)
        self.missing, self.left, self.right = np.array(tree.missing), np.array(tree.left), np.array(tree.right)
        self.value = np.array(tree.value)
        self.numeric = self.column < len(layout.numeric)
        self.empty = layout.bins[np.maximum(self.column, 0)]

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        live = np.arange(len(codes)) if self.column[0] >= 0 else np.zeros(0, np.int64)
        while len(live):
            now = at[live]
            code = codes[live, self.column[now]]
            left = np.where(self.numeric[now], code <= self.bin[now], code == self.bin[now])
            left = np.where(code == self.empty[now], self.missing[now], left)
            at[live] = np.where(left, self.left[now], self.right[now])
            live = live[self.column[at[live]] >= 0]
        return at


@dataclass(frozen=True)
class Growth:
    """Rules of splitting. Sums are (rows, H, G): for forests H is the weight and G the weighted target."""

    l2: float = 0.0
    step: float = 1.0
    max_depth: int | None = None
    min_rows: int = 1
    min_cover: float = 0.0
    columns_per_tree: float = 1.0
    columns_per_node: float | str = 1.0  # a share, or "sqrt"


def _hashed(x: np.ndarray, const: list[int], mult: int) -> np.ndarray:
    x = x ^ np.uint32(const[0])
    const[0] = const[0] * mult & 0xFFFFFFFF
    x = x * np.uint32(const[0])
    return x ^ (x >> np.uint32(16))


def generator_states(seed: Sequence[int], last: np.ndarray) -> list[tuple[int, int]]:
    """State and increment of ``default_rng([*seed, x])`` for every x of ``last`` (63 bits), for a seed of two numbers of 32 bits:
    numpy's SeedSequence and the start of its PCG64, for all x at once."""
    words = [np.full(len(last), w, np.uint32) for w in seed]
    words += [(last & np.uint64(0xFFFFFFFF)).astype(np.uint32), (last >> np.uint64(32)).astype(np.uint32)]
    const = [0x43B0D7E5]
    pool = [_hashed(w, const, 0x931E8875) for w in words]
    for source in range(4):
        for to in range(4):
            if source != to:
                mixed = np.uint32(0xCA01F9DD) * pool[to] - np.uint32(0x4973F715) * _hashed(pool[source], const, 0x931E8875)
                pool[to] = mixed ^ (mixed >> np.uint32(16))
    const = [0x8B51F9DD]
    out = [_hashed(pool[i % 4], const, 0x58F38DED).astype(np.uint64) for i in range(8)]
    whole = [(out[i] | out[i + 1] << np.uint64(32)).tolist() for i in range(0, 8, 2)]
    mult, mask = 0x2360ED051FC65DA44385DF649FCCF645, (1 << 128) - 1
    found = []
    for a, b, c, d in zip(*whole):
        inc = ((c << 64 | d) << 1 | 1) & mask
        found.append((((inc + (a << 64 | b)) * mult + inc) & mask, inc))
    return found


class Splitter:
    """Finds the best splits of open nodes from their histograms."""

    def __init__(self, layout: Layout, rules: Growth) -> None:
        bins, first = layout.bins, layout.offsets
        self.layout, self.rules, self.first, self.bins = layout, rules, first[:-1], bins
        self.slots = int(first[-1])
        self.column = np.repeat(np.arange(len(bins)), bins + 1)
        place = np.arange(self.slots) - self.first[self.column]
        self.numeric = self.column < len(layout.numeric)
        self.possible = np.where(self.numeric, place < bins[self.column] - 1, place < bins[self.column])
        # what is drawn for a tree or node: a number is one column, a category one for each value
        number = np.concatenate(([0], np.cumsum(np.where(np.arange(len(bins)) < len(layout.numeric), 1, bins))))
        self.drawn = np.minimum(number[self.column] + np.where(self.numeric, 0, place), max(int(number[-1]) - 1, 0))
        self.n_drawn = int(number[-1])

    def open_columns(self, seed: Sequence[int], share: float | str) -> np.ndarray:
        """Order in which the drawn columns are tried, from 0; those behind the share get the number of columns added."""
        if share == 1.0:
            return np.zeros(self.n_drawn, np.int64)
        order = np.random.default_rng([x & 0x7FFFFFFFFFFFFFFF for x in seed]).permutation(self.n_drawn)
        count = max(1, int(self.n_drawn ** 0.5) if share == "sqrt" else int(self.n_drawn * share))
        return np.where(order < count, 0, self.n_drawn + order)

    def tries(self, seed: Sequence[int], paths: np.ndarray, share: float | str) -> np.ndarray:
        """What open_columns gives for the nodes of a tree (``seed``, path), as rows."""
        if share == 1.0:
            return np.zeros((len(paths), self.n_drawn), np.int64)
        if len(seed) != 2 or not all(0 <= x < 1 << 32 for x in seed):
            return np.stack([self.open_columns([*seed, int(p)], share) for p in paths])
        count = max(1, int(self.n_drawn ** 0.5) if share == "sqrt" else int(self.n_drawn * share))
        bits = np.random.PCG64(0)
        dice, state = np.random.Generator(bits), bits.state
        order = np.empty((len(paths), self.n_drawn), np.int64)
        for i, (at, inc) in enumerate(generator_states(seed, paths)):
            state["state"] = {"state": at, "inc": inc}
            bits.state = state
            order[i] = dice.permutation(self.n_drawn)
        return np.where(order < count, 0, self.n_drawn + order)

    def splits(self, sums: np.ndarray, fills: np.ndarray, order: np.ndarray, fallback: bool) -> Iterator[tuple | None]:
        """For each node (sums: nodes, slots, 3) its best (column, bin, missing goes left, left sums, right sums), if any.

        ``order``: what open_columns gave for each node. With ``fallback`` a node without a split in its share takes the first
        column that has one.
        """
        nodes, each = np.arange(len(sums))[:, None], np.arange(len(self.bins))[None, :]
        missing = self.first[None, :] + self.bins[None, :]
        target = self.first[None, :] + fills
        held = sums[nodes, missing] * (fills < self.bins)[:, :, None]
        sums[nodes, missing] = 0
        np.add.at(sums, (nodes + 0 * each, np.where(fills < self.bins, target, missing)), held)
        total = sums[:, self.first[0]:self.first[0] + self.bins[0] + 1].sum(axis=1, keepdims=True) if len(self.bins) else sums[:, :0]
        before = np.concatenate([np.zeros((len(sums), 1, 3)), np.cumsum(sums, axis=1)], axis=1)
        left = np.where(self.numeric[None, :, None], before[:, 1:] - before[:, self.first[self.column]], sums)
        right = total - left
        r = self.rules
        with np.errstate(divide="ignore", invalid="ignore"):
            part = lambda s: np.where(s[..., 1] + r.l2 > 1e-12, s[..., 2] ** 2 / (s[..., 1] + r.l2), 0.0)
            gain = part(left) + part(right) - part(total)
        good = self.possible & (left[..., 0] >= r.min_rows) & (right[..., 0] >= r.min_rows) & (
            left[..., 1] >= r.min_cover) & (right[..., 1] >= r.min_cover) & (gain > LEAST_GAIN)
        for k in range(len(sums)):
            tried = order[k][self.drawn]
            open_ = good[k] & (tried == 0)
            if not open_.any() and fallback and good[k].any():
                open_ = good[k] & (tried == tried[good[k]].min())
            if not open_.any():
                yield None
                continue
            tops = np.where(open_, gain[k], -np.inf)
            slot = int(np.argmax(tops >= tops.max() * (1 - 1e-9)))  # the first of equal splits, whatever the order of sums
            c = int(self.column[slot])
            b = slot - int(self.first[c])
            f = int(fills[k, c])
            yield c, b, bool(f < self.bins[c] and (f <= b if self.numeric[slot] else f == b)), left[k, slot], right[k, slot]


def histogram(codes: np.ndarray, node: np.ndarray, nodes: int, weights: Sequence[np.ndarray], first: np.ndarray, slots: int) -> np.ndarray:
    """Sums of each weight by (node, slot); rows with node -1 count nowhere."""
    inside = np.flatnonzero(node >= 0)
    flat = (node[inside, None] * slots + first[None, :] + codes[inside]).ravel()
    width = codes.shape[1]
    return np.stack([np.bincount(flat, np.repeat(w[inside], width), nodes * slots) for w in weights], axis=1).reshape(nodes, slots, len(weights))


def split_nodes(tree: Tree, open_: list[int], sums: np.ndarray, splitter: Splitter, fills: np.ndarray, seed: Sequence[int], allowed: np.ndarray | None,
                depth: int) -> list[int]:
    """Split the open nodes of a tree; returns the children that can be split further."""
    r = splitter.rules
    if allowed is None:
        order = np.stack([splitter.open_columns([*seed, tree.path[n] & 0x7FFFFFFFFFFFFFFF], r.columns_per_node) for n in open_])
    else:
        order = np.broadcast_to(allowed, (len(open_), len(allowed)))
    leaf = lambda s: r.step * s[2] / (s[1] + r.l2) if s[1] + r.l2 > 1e-12 else 0.0
    children = []
    for node, found in zip(open_, splitter.splits(sums, np.broadcast_to(fills, (len(open_), len(fills))), order, allowed is None)):
        if found is None:
            continue
        tree.column[node], tree.bin[node], tree.missing[node] = found[:3]
        for side, s in enumerate(found[3:]):
            child = tree.add(float(leaf(s)), float(s[1]), 2 * tree.path[node] + side)
            (tree.right if side else tree.left)[node] = child
            if s[0] >= 2 * r.min_rows and (r.max_depth is None or depth + 1 < r.max_depth):
                children.append(child)
    return children


# --- blocks of binned rows --------------------------------------------------------------------------------------------

@dataclass
class Block:
    """Rows of the training table: hash of the key, target, fold and bins."""

    key: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    codes: np.ndarray
    margin: np.ndarray | None = None


def blocks_of(train: DataFrame, layout: Layout, key: str, label: str = "label", fold: str | None = None) -> RDD:
    """Binned rows, written once; a lost block is read again."""
    rows = train.select(F.xxhash64(key).alias("key"), F.col(label).cast("double").alias("y"),
                        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"), *inputs_of(train, layout.numeric, layout.categorical))
    parts = -(-rows.count() // BLOCK_ROWS) or 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            columns = [t.column(i).to_numpy() for i in range(t.num_columns)]
            block = Block(columns[0].view(np.uint64), columns[1], columns[2], layout.codes(columns[3:]).astype(np.int16))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    written = settle(rows.repartition(parts, "key").mapInArrow(pack, "block binary"), "tree-blocks")
    return written.rdd.map(lambda r: pickle.loads(bytes(r["block"]))).persist(StorageLevel.MEMORY_AND_DISK)


def draw(key: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for every row key and seed."""
    h = key ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53


def _add(a, b):
    return a if b is None else b if a is None else a + b


DIRECT = 16  # partitions whose sums go to the driver without a level of tasks between


def added_up(blocks: RDD, part: Callable[[Block], np.ndarray]) -> np.ndarray | None:
    """Sum of part(block) over all blocks, merged in a tree of tasks."""
    sums = blocks.mapPartitions(_Summed(part))
    return _sum_all(sums.collect()) if blocks.getNumPartitions() <= DIRECT else sums.treeReduce(_add)


class _Summed:
    """The sum of a function over the blocks of a partition."""

    def __init__(self, part: Callable[[Block], np.ndarray]) -> None:
        self.part = part

    def __call__(self, held: Iterable[Block]) -> list[np.ndarray | None]:
        return [_sum_all(self.part(b) for b in held)]


def _sum_all(parts: Iterable[np.ndarray]) -> np.ndarray | None:
    total = None
    for p in parts:
        if p is not None:
            total = p if total is None else total + p
    return total


# --- boosting ---------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Boosting:
    rounds: int
    step: float
    depth: int = 4
    l2: float = 2.0
    rows: float = 0.85
    columns: float = 0.85
    min_cover: float = 1.0
    logistic: bool = True
    seed: int = 42


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def in_fold_rows(block: Block, model: int, folds: int) -> np.ndarray:
    """Models 0 .. folds-1 leave their fold out; the one behind them sees all rows."""
    return block.fold != model if model < folds else np.ones(len(block.y), bool)


@dataclass
class Ensemble:
    """Trees of one model with what they need to score raw rows."""

    layout: Layout
    fills: Fills
    trees: Sequence[Tree]
    base: float
    mean: bool  # forest: the mean of the trees, else base plus their sum

    def margins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        codes = self.layout.codes(columns)
        return self.of_codes(codes)

    def of_codes(self, codes: np.ndarray) -> np.ndarray:
        total = np.zeros(len(codes))
        for tree in self.trees:
            router = Router(tree, self.layout)
            total += router.value[router.nodes(codes)]
        return self.base + (total / max(1, len(self.trees)) if self.mean else total)


@dataclass
class _Round:
    """Brings the margins of a block up to date with the trees since they were last kept."""

    layout: Layout
    rules: Boosting
    folds: int
    models: list[int]
    base: np.ndarray
    heavy: np.ndarray
    done: list[list[Tree]] = field(default_factory=list)

    def __call__(self, b: Block) -> Block:
        margin = np.tile(self.base, (len(b.y), 1)) if b.margin is None else b.margin.copy()
        for trees in self.done:
            for i, tree in enumerate(trees):
                router = Router(tree, self.layout)
                margin[:, i] += router.value[router.nodes(b.codes)]
        return Block(b.key, b.y, b.fold, b.codes, margin)


@dataclass
class _Level:
    """Sums of a block for one level of the growing trees of all models: (model, open node, slot) by H, H and G."""

    round: _Round
    growing: list[Tree]
    open: list[list[int]]
    number: int

    def __call__(self, b: Block) -> np.ndarray:
        r, layout = self.round, self.round.layout
        margin, first = r(b).margin, layout.offsets
        used = draw(b.key, r.rules.seed + 1000 * self.number) < r.rules.rows
        out = np.zeros((len(self.open), max(map(len, self.open)), int(first[-1]), 3))
        for i, nodes in enumerate(self.open):
            if not nodes:
                continue
            if r.rules.logistic:
                p, w = _sigmoid(margin[:, i]), np.where(b.y == 1, r.heavy[i], 1.0)
                h, g = w * np.maximum(p * (1 - p), 1e-16), w * (b.y - p)
            else:
                h, g = np.ones(len(b.y)), b.y - margin[:, i]
            place = np.full(len(self.growing[i].column), -1)
            place[nodes] = np.arange(len(nodes))
            at = np.where(used & in_fold_rows(b, r.models[i], r.folds), place[Router(self.growing[i], layout).nodes(b.codes)], -1)
            out[i, :len(nodes), :, 1:] = histogram(b.codes, at, len(nodes), (h, g), first[:-1], int(first[-1]))
        out[..., 0] = out[..., 1]  # rows are counted by their curvature: the least cover is asked of it
        return out


def _rounds(keep: Callable[[_Round], None], sums: Callable[[_Level], np.ndarray], state: _Round, fill_bins: np.ndarray, refresh: int) -> list[list[Tree]]:
    """The trees of the models of ``state``; ``sums`` adds up a level over all rows, ``keep`` renews the rows' margins."""
    s = state.rules
    splitter = Splitter(state.layout, Growth(l2=s.l2, step=s.step, max_depth=s.depth, min_rows=0, min_cover=s.min_cover))
    found: list[list[Tree]] = [[] for _ in state.models]
    stale: list[list[Tree]] = []
    for number in range(s.rounds):
        if len(stale) == refresh:
            keep(replace(state, done=stale))
            stale = []
        growing, open_ = [Tree() for _ in state.models], [[0] for _ in state.models]
        allowed = splitter.open_columns([s.seed, number], s.columns)
        for depth in range(s.depth):
            if not any(open_):
                break
            total = sums(_Level(replace(state, done=stale), growing, open_, number))
            for i, nodes in enumerate(open_):
                if nodes:
                    open_[i] = split_nodes(growing[i], nodes, total[i, :len(nodes)], splitter, fill_bins[i], (), allowed, depth)
        for i, tree in enumerate(growing):
            found[i].append(tree)
        stale = [*stale, growing]
    return found


@dataclass
class _InOneTask:
    """All rounds of one model over the whole table."""

    state: _Round
    fill_bins: np.ndarray

    def __call__(self, i: int, blocks: Sequence[Block]) -> list[bytes]:
        state, s, fills = self.state, self.state.rules, self.fill_bins[i]
        b = whole_block(blocks)
        splitter = Splitter(state.layout, Growth(l2=s.l2, step=s.step, max_depth=s.depth, min_rows=0, min_cover=s.min_cover))
        columns = _filled(b.codes, splitter, fills)
        joint = _Joint(columns, splitter, fills)
        inside, every = in_fold_rows(b, state.models[i], state.folds), np.arange(len(b.y))
        margin, weight, found = np.full(len(b.y), state.base[i]), np.where(b.y == 1, state.heavy[i], 1.0), []
        for number in range(s.rounds):
            rows = np.flatnonzero(inside & (draw(b.key, s.seed + 1000 * number) < s.rows))
            if s.logistic:
                p, w = _sigmoid(margin[rows]), weight[rows]
                h, g = w * np.maximum(p * (1 - p), 1e-16), w * (b.y[rows] - p)
            else:
                h, g = np.ones(len(rows)), b.y[rows] - margin[rows]
            allowed = splitter.open_columns([s.seed, number], s.columns)
            tree, open_, at, codes = Tree(), [0], np.zeros(len(b.y), np.int64), joint.codes[:, rows]
            for depth in range(s.depth):
                if not open_:
                    break
                place = np.full(len(tree.column), -1)
                place[open_] = np.arange(len(open_))
                sums = joint.sums(codes, place[at[rows]], len(open_), h, g)
                open_ = split_nodes(tree, open_, sums, splitter, fills, (), allowed, depth)
                column, to = np.array(tree.column)[at], np.array([tree.left, tree.right])
                code = columns[np.maximum(column, 0), every]
                limit = np.array(tree.bin)[at]
                goes_left = np.where(column < len(state.layout.numeric), code <= limit, code == limit)
                at = np.where(column >= 0, to[np.where(goes_left, 0, 1), at], at)
            margin += np.array(tree.value)[at]
            found.append(tree.pack())
        return found


class _Joint:
    """Codes of several columns as one number, so that one count over the rows gives the sums of all of them."""

    def __init__(self, columns: np.ndarray, splitter: Splitter, fills: np.ndarray, cells: int = 1024) -> None:
        self.splitter, widths = splitter, splitter.bins + (fills >= splitter.bins)  # missing values that have no fill need a place
        self.groups: list[tuple[list[int], list[int]]] = []
        for c in np.argsort(-widths, kind="stable").tolist():
            room = next((g for g in self.groups if np.prod(g[1]) * widths[c] <= cells), None)
            if room is None:
                self.groups.append(([c], [int(widths[c])]))
            else:
                room[0].append(c)
                room[1].append(int(widths[c]))
        self.codes = np.zeros((len(self.groups), columns.shape[1]), np.int64)
        for held, (members, sizes) in zip(self.codes, self.groups):
            for c, size in zip(members, sizes):
                held *= size
                held += columns[c]

    def sums(self, codes: np.ndarray, node: np.ndarray, nodes: int, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """(node, slot) by H, H and G; rows with node -1 count nowhere."""
        out = np.zeros((nodes, self.splitter.slots, 3))
        some = np.flatnonzero(node >= 0) if len(node) and node.min() < 0 else None
        if some is not None:
            node, h, g = node[some], h[some], g[some]
        for code, (members, sizes) in zip(codes, self.groups):
            width = int(np.prod(sizes))
            cell = node * width
            cell += code if some is None else code[some]
            for k, x in ((1, h), (2, g)):
                cube = np.bincount(cell, x, nodes * width).reshape(nodes, *sizes)
                for axis, (c, size) in enumerate(zip(members, sizes), start=1):
                    first = int(self.splitter.first[c])
                    out[:, first:first + size, k] = cube.sum(axis=tuple(a for a in range(1, len(sizes) + 1) if a != axis))
        out[..., 0] = out[..., 1]  # rows are counted by their curvature: the least cover is asked of it
        return out


def whole_block(blocks: Sequence[Block]) -> Block:
    """All rows of some blocks in one, in an order that does not depend on that of the blocks."""
    held = sorted((b for b in blocks if len(b.y)), key=lambda b: (int(b.key[0]), len(b.y)))
    return held[0] if len(held) == 1 else Block(*[np.concatenate([getattr(b, f) for b in held]) for f in ("key", "y", "fold", "codes")])


def with_all_blocks(blocks: RDD, tasks: int) -> RDD:
    """(number, all blocks) for tasks that each need the whole table."""
    return blocks.flatMap(lambda b: [(i, b) for i in range(tasks)]).groupByKey(tasks, int)


def boost(blocks: RDD, layout: Layout, fills: Sequence[Fills], folds: int, s: Boosting, one_task: bool | None = None) -> list[Ensemble]:
    """``folds`` models that each leave one fold out, and one of all rows.

    All models are grown together, one job a level. A table of at most ``TASK_ROWS`` rows goes to one task for each model instead,
    which goes through the same rounds; the trees are the same.
    """
    models = list(range(folds + 1))
    fill_bins = np.stack([f.bins(layout) for f in fills])

    def counts(b: Block) -> np.ndarray:
        inside = [in_fold_rows(b, m, folds) for m in models]
        return np.array([[rows.sum(), b.y[rows].sum()] for rows in inside], np.float64)

    totals = added_up(blocks, counts)
    if totals is None:
        return [Ensemble(layout, f, [], 0.0, False) for f in fills]
    n, ones = totals[:, 0], totals[:, 1]
    heavy = np.where(ones > 0, (n - ones) / np.maximum(ones, 1), 1.0) if s.logistic else np.ones(len(models))  # weight of the positives
    share = np.clip(heavy * ones / np.maximum(n - ones + heavy * ones, 1e-12), 1e-6, 1 - 1e-6) if s.logistic else None
    base = np.log(share / (1 - share)) if s.logistic else ones / np.maximum(n, 1)
    state = _Round(layout, s, folds, models, base, heavy)
    if one_task if one_task is not None else n[-1] <= TASK_ROWS:
        grow = _InOneTask(state, fill_bins)
        found = dict(with_all_blocks(blocks, len(models)).map(lambda job: (job[0], grow(*job))).collect())  # the trees themselves
        return [Ensemble(layout, f, HeldTrees(found[m]), float(base[m]), False) for m, f in enumerate(fills)]
    rows = [blocks]

    def keep(r: _Round) -> None:
        before = rows[0]
        rows[0] = before.map(r).persist(StorageLevel.MEMORY_AND_DISK)
        rows[0].count()
        if before is not blocks:
            before.unpersist()

    found = _rounds(keep, lambda level: added_up(rows[0], level), state, fill_bins, REFRESH)
    if rows[0] is not blocks:
        rows[0].unpersist()
    return [Ensemble(layout, f, HeldTrees([t.pack() for t in trees]), float(base[m]), False) for m, (f, trees) in enumerate(zip(fills, found))]


# --- forests ----------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Forest:
    trees: int
    min_rows: int
    columns: float | str
    max_depth: int | None = None
    balanced: bool = True  # class weights inside each bootstrap
    seed: int = 42


def bootstrap_counts(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's bootstrap: a Poisson number of mean 1."""
    u = draw(key, seed + 7919 * (tree + 1))
    limits = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate(([1.0], np.arange(1.0, 12.0)))))
    return np.searchsorted(limits, u, side="right")


def bootstrap_weights(count: np.ndarray, y: np.ndarray, sizes: np.ndarray | None) -> np.ndarray:
    """Row weights of a bootstrap; ``sizes`` (rows of class 0, rows of class 1) balances the classes."""
    if sizes is None:
        return count.astype(np.float64)
    weight = sizes.sum() / (2 * np.maximum(sizes, 1))
    return count * np.where(y == 1, weight[1], weight[0])


@dataclass
class _Task:
    """One tree being grown: its model, number, class sizes and open nodes."""

    model: int
    number: int
    sizes: np.ndarray | None
    tree: Tree
    open: list[int]


class _Rows:
    """The rows of a bootstrap and their sums (rows, H, G) by cell. Where counts are whole and small enough, the sums of a cell are one
    number: rows, and counts of class 0 and 1, side by side in the 53 bits of a double."""

    def __init__(self, y: np.ndarray, count: np.ndarray, sizes: np.ndarray | None) -> None:
        weight = bootstrap_weights(count, y, sizes)
        self.whole = weight.sum(), (weight * y).sum()
        self.classes = bool(((y == 0) | (y == 1)).all())
        fits = len(y) < 1 << 17 and count.sum() < 1 << 18
        self.kind = "classes" if self.classes and fits else "counts" if sizes is None and fits else "weights"
        self.each = bootstrap_weights(np.ones(2), np.arange(2), sizes)
        if self.kind == "classes":
            self.held = [1.0 + count * np.where(y == 1, float(1 << 35), float(1 << 17))]
        elif self.kind == "counts":
            self.held = [1.0 + count * float(1 << 17), weight * y]
        else:
            self.held = [np.ones(len(y)), weight, weight * y]

    def sums(self, cells: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, H and G from sums of ``held``."""
        if self.kind == "weights":
            return tuple(cells)
        whole = cells[0].astype(np.int64)
        n = (whole & ((1 << 17) - 1)).astype(np.float64)
        if self.kind == "counts":
            return n, (whole >> 17).astype(np.float64), cells[1]
        g = (whole >> 35) * self.each[1]
        return n, (whole >> 17 & ((1 << 18) - 1)) * self.each[0] + g, g


def _part(h: np.ndarray, g: np.ndarray, l2: float) -> np.ndarray:
    enough = h + l2 > 1e-12
    return np.where(enough, g * g / np.where(enough, h + l2, 1.0), 0.0)


def _best_of(splitter: Splitter, columns: np.ndarray, held: _Rows, at: np.ndarray, rows: np.ndarray, whole: np.ndarray, tried: np.ndarray,
             fallback: bool) -> tuple[np.ndarray, np.ndarray]:
    """The best split of each node: its slot (-1: none) and the sums of its left side.

    ``at`` and ``rows``: nodes and numbers of the rows; ``whole``: sums of each node; ``tried``: the order of trial of each node's drawn
    columns. A node looks at those of order 0, or with ``fallback`` at the first that has a split. Only the columns that a node looks
    at are added up, and only bins with rows are tried: an empty one splits like the one before it.
    """
    r, m = splitter.rules, len(whole)
    base = _part(whole[:, 1], whole[:, 2], r.l2)
    looked = tried == 0
    found: list[tuple] = []
    for c, bins in enumerate(splitter.bins):
        first, width = int(splitter.first[c]), int(bins) + 1
        numeric = splitter.numeric[first]
        if fallback:
            nodes = None
        else:
            open_ = looked[:, splitter.drawn[first:first + (1 if numeric else int(bins))]]
            wanted = open_.any(axis=1)
            nodes = None if wanted.all() else np.flatnonzero(wanted)
        if nodes is None:
            mine, own = at, rows
        elif len(nodes):
            inside = np.flatnonzero(wanted[at])
            mine, own = (np.cumsum(wanted) - 1)[at[inside]], rows[inside]
        else:
            continue
        k = m if nodes is None else len(nodes)
        own = slice(None) if len(own) == columns.shape[1] else own  # all rows, in their order
        cell = mine * width + columns[c][own]
        cells = [np.bincount(cell, x[own], k * width).reshape(k, width) for x in held.held]
        full = cells[0][:, :-1] > 0
        if numeric:
            full[:, -1:] = False
            cells = [np.cumsum(x, axis=1) for x in cells]
        if not fallback and not numeric:
            full &= open_ if nodes is None else open_[nodes]
        node, bin_ = np.nonzero(full)
        n, h, g = held.sums([x[node, bin_] for x in cells])
        if nodes is not None:
            node = nodes[node]
        other = whole[node, 0] - n, whole[node, 1] - h, whole[node, 2] - g
        gain = _part(h, g, r.l2) + _part(other[1], other[2], r.l2) - base[node]
        good = np.flatnonzero((n >= r.min_rows) & (other[0] >= r.min_rows) & (h >= r.min_cover) & (other[1] >= r.min_cover) & (gain > LEAST_GAIN))
        found.append((node[good], first + bin_[good], gain[good], np.stack([n[good], h[good], g[good]], axis=1)))
    slot, left = np.full(m, -1), np.zeros((m, 3))
    if not found:
        return slot, left
    node, slots, gain, sums = (np.concatenate(x) for x in zip(*found))
    if fallback:
        order, least = tried[node, splitter.drawn[slots]], np.full(m, np.iinfo(np.int64).max)
        np.minimum.at(least, node, order)
        kept = np.flatnonzero(order == least[node])
        node, slots, gain, sums = node[kept], slots[kept], gain[kept], sums[kept]
    top, place = np.full(m, -np.inf), np.full(m, len(node))
    np.maximum.at(top, node, gain)
    near = np.flatnonzero(gain >= top[node] * (1 - 1e-9))
    np.minimum.at(place, node[near], near)  # the first of equal splits, whatever the order of sums
    some = np.flatnonzero(place < len(node))
    slot[some], left[some] = slots[place[some]], sums[place[some]]
    return slot, left


def _only(kept: np.ndarray, m: int, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of some of m nodes, which are numbered anew."""
    if len(kept) == m:
        return at, rows
    number = np.full(m, -1)
    number[kept] = np.arange(len(kept))
    to = number[at]
    inside = np.flatnonzero(to >= 0)
    return to[inside], rows[inside]


def _filled(codes: np.ndarray, splitter: Splitter, fills: np.ndarray) -> np.ndarray:
    """Codes by column, with each missing value at its fill."""
    columns = np.ascontiguousarray(codes.T)
    for c, (n, f) in enumerate(zip(splitter.bins, fills)):
        if f < n:
            columns[c][columns[c] == n] = f
    return columns


def _grow_here(columns: np.ndarray, held: _Rows, splitter: Splitter, fills: np.ndarray, tries: Callable[[np.ndarray], np.ndarray],
               root: tuple[float, float], fallback: bool, path: int = 1, depth: int = 0) -> Tree:
    """The whole tree below one node, from its rows; ``tries`` gives the order of trial of the nodes at some paths, ``root`` the value and
    cover of the first. Rows in a finished leaf are left behind."""
    r = splitter.rules
    column, bin_, left = [np.full(1, -1)], [np.zeros(1, int)], [np.zeros(1, int)]
    value, cover = [np.array([root[0]])], [np.array([root[1]])]
    paths, ids, made = np.array([path & 0x7FFFFFFFFFFFFFFF], np.uint64), np.zeros(1, np.int64), 1
    at, rows = np.zeros(columns.shape[1], np.int64), np.arange(columns.shape[1])
    split_at: list[tuple] = []
    while len(ids) and len(columns):
        whole = np.stack(held.sums([np.bincount(at, x[rows], len(ids)) for x in held.held]), axis=1)
        slot, sums = np.full(len(ids), -1), np.zeros((len(ids), 3))
        one_class = held.classes and r.l2 == 0  # then a node of one class has no gain
        mixed = np.flatnonzero((whole[:, 2] > 0) & (whole[:, 2] < whole[:, 1] * (1 - 1e-12))) if one_class else np.arange(len(ids))
        if len(mixed):
            here = _only(mixed, len(ids), at, rows)
            tried = tries(paths[mixed])
            slot[mixed], sums[mixed] = _best_of(splitter, columns, held, *here, whole[mixed], tried, False)
            none = np.flatnonzero(slot[mixed] < 0)
            if len(none) and fallback:
                slot[mixed[none]], sums[mixed[none]] = _best_of(splitter, columns, held, *_only(none, len(mixed), *here), whole[mixed[none]], tried[none], True)
        done = np.flatnonzero(slot >= 0)
        c = splitter.column[slot[done]]
        b = slot[done] - splitter.first[c]
        both = np.stack([sums[done], whole[done] - sums[done]], axis=1).reshape(-1, 3)  # left and right of each
        children = made + np.arange(2 * len(done))
        split_at.append((ids[done], c, b, children[::2]))
        made += len(children)
        for parts, x in ((column, -1), (bin_, 0), (left, 0)):
            parts.append(np.full(len(children), x))
        enough = both[:, 1] + r.l2 > 1e-12
        value.append(np.where(enough, r.step * both[:, 2] / np.where(enough, both[:, 1] + r.l2, 1.0), 0.0))
        cover.append(both[:, 1])
        further = (both[:, 0] >= 2 * r.min_rows) & (r.max_depth is None or depth + 1 < r.max_depth)
        number = np.full((len(ids), 2), -1)
        number[done] = np.where(further, np.cumsum(further) - 1, -1).reshape(-1, 2)
        paths = ((paths[done, None] << np.uint64(1) | np.array([[0, 1]], np.uint64)) & np.uint64(0x7FFFFFFFFFFFFFFF)).ravel()[further]
        ids = children[further]
        # rows of open children go on, in their order
        column_of, bin_of = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        column_of[done], bin_of[done] = c, b
        going = np.flatnonzero((number >= 0).any(axis=1)[at])
        at, rows = at[going], rows[going]
        code = columns[column_of[at], rows]
        goes_left = np.where(column_of[at] < len(splitter.layout.numeric), code <= bin_of[at], code == bin_of[at])
        at = number[at, np.where(goes_left, 0, 1)]
        kept = np.flatnonzero(at >= 0)
        at, rows = at[kept], rows[kept]
        depth += 1
    column, bin_, left = np.concatenate(column), np.concatenate(bin_), np.concatenate(left)
    right, missing = left.copy(), np.zeros(made, bool)
    for nodes, c, b, first in split_at:
        column[nodes], bin_[nodes], left[nodes], right[nodes] = c, b, first, first + 1
        f = fills[c]
        missing[nodes] = (f < splitter.bins[c]) & np.where(c < len(splitter.layout.numeric), f <= b, f == b)
    return Tree(column, bin_, missing, left, right, np.concatenate(value), np.concatenate(cover), [])


def _forest_tree(codes: np.ndarray, y: np.ndarray, count: np.ndarray, sizes: np.ndarray | None, splitter: Splitter, fills: np.ndarray, seed: Sequence[int],
                 path: int, depth: int) -> Tree:
    """A tree of a forest below one node, from the node's rows and their counts in the bootstrap."""
    held, share = _Rows(y, count, sizes), splitter.rules.columns_per_node
    total, target = held.whole
    return _grow_here(_filled(codes, splitter, fills), held, splitter, fills, lambda paths: splitter.tries(seed, paths, share),
                      (target / total if total > 0 else 0.0, total), share != 1.0, path, depth)


def grow_forests(blocks: RDD, layout: Layout, fills: Sequence[Fills], folds: int, s: Forest, local_rows: int = LOCAL_ROWS,
                 cells: int = HISTOGRAM_CELLS) -> list[Ensemble]:
    """A forest that leaves each fold out, and one of all rows."""
    models = folds + 1
    rules = Growth(min_rows=s.min_rows, max_depth=s.max_depth, columns_per_node=s.columns)
    splitter = Splitter(layout, rules)
    fill_bins = np.stack([f.bins(layout) for f in fills])
    first, slots, seed, balanced, n_trees = splitter.first, splitter.slots, s.seed, s.balanced, s.trees

    def bag(b: Block, model: int, number: int) -> np.ndarray:
        return np.where(in_fold_rows(b, model, folds), bootstrap_counts(b.key, number, seed), 0)

    def roots(b: Block) -> np.ndarray:
        """(model, tree, class): rows, bootstrap rows, bootstrap sum of the target."""
        out = np.zeros((models, n_trees, 2, 3))
        for number in range(n_trees):
            counts = bootstrap_counts(b.key, number, seed)
            for m in range(models):
                c = np.where(in_fold_rows(b, m, folds), counts, 0)
                for k in (0, 1):
                    mine = (b.y == 1) == bool(k)
                    out[m, number, k] = (c[mine] > 0).sum(), c[mine].sum(), (c[mine] * b.y[mine]).sum()
        return out

    start = added_up(blocks, roots)
    if start is None:
        return [Ensemble(layout, f, [], 0.0, True) for f in fills]
    waiting: list[_Task] = []
    finished: list[_Task] = []
    local: list[tuple[_Task, int, int]] = []
    for m in range(models):
        for number in range(n_trees):
            found = start[m, number]
            sizes = found[:, 1] if balanced else None
            weights = bootstrap_weights(np.ones(2), np.arange(2), sizes)
            total = float((weights * found[:, 1]).sum())
            tree = Tree(value=[float((weights * found[:, 2]).sum() / total) if total else 0.0], cover=[total])
            task = _Task(m, number, sizes, tree, [])
            finished.append(task)
            rows = found[:, 0].sum()
            if rows <= local_rows:
                local.append((task, 0, 0))
            elif rows >= 2 * s.min_rows and s.max_depth != 0:
                task.open = [0]
                waiting.append(task)

    depth = 0
    while waiting:  # nodes of more rows than one task takes
        ahead: list[_Task] = []
        at = 0
        while at < len(waiting):
            group, used = [], 0
            while at < len(waiting) and (not group or used + len(waiting[at].open) * slots <= cells):
                group.append(waiting[at])
                used += len(waiting[at].open) * slots
                at += 1
            job = [(t.model, t.number, t.sizes, t.tree, t.open) for t in group]

            def level(b: Block, job=job) -> np.ndarray:
                out = []
                for model, number, sizes, tree, nodes in job:
                    c = bag(b, model, number)
                    w = bootstrap_weights(c, b.y, sizes)
                    spot = np.full(len(tree.column), -1)
                    spot[nodes] = np.arange(len(nodes))
                    where = np.where(c > 0, spot[Router(tree, layout).nodes(b.codes)], -1)
                    out.append(histogram(b.codes, where, len(nodes), (np.ones(len(w)), w, w * b.y), first, slots))
                return np.concatenate(out)

            sums, place = added_up(blocks, level), 0
            for t in group:
                mine = sums[place:place + len(t.open)]
                place += len(t.open)
                # a child's rows are those of its side of the split, so they are read before the sums are changed
                children = split_nodes(t.tree, t.open, mine, splitter, fill_bins[t.model], (seed, t.number), None, depth)
                t.open = children
                if children:
                    ahead.append(t)
        depth += 1
        waiting = []
        if ahead:
            job = [(t.model, t.number, t.tree, t.open) for t in ahead]

            def sizes_of(b: Block, job=job) -> np.ndarray:
                return np.concatenate([np.bincount(Router(tree, layout).nodes(b.codes)[bag(b, model, number) > 0], minlength=len(tree.column))[nodes]
                                       for model, number, tree, nodes in job])

            sizes, place = added_up(blocks, sizes_of), 0
            for t in ahead:
                mine = sizes[place:place + len(t.open)]
                place += len(t.open)
                local += [(t, n, depth) for n, k in zip(t.open, mine) if k <= local_rows]
                t.open = [n for n, k in zip(t.open, mine) if k > local_rows]
                if t.open:
                    waiting.append(t)

    if local and len(local) == len(finished) and not any(node for _, node, _ in local):  # every tree is one task's work
        return _stored_forests(blocks, layout, fills, folds, s, splitter, fill_bins, [(t.model, t.number, t.sizes) for t in finished])
    jobs = [(i, t.model, t.number, t.sizes, t.tree if node else None, node, t.tree.path[node], d) for i, (t, node, d) in enumerate(local)]
    held = blocks.context.broadcast(jobs)  # open nodes and their trees, no rows

    def parts(b: Block) -> Iterator[tuple[int, tuple]]:
        for i, model, number, _, tree, node, _, _ in held.value:
            c = bag(b, model, number)
            inside = c > 0 if tree is None else (c > 0) & (Router(tree, layout).nodes(b.codes) == node)
            rows = np.flatnonzero(inside)
            if len(rows):
                yield i, (b.codes[rows], b.y[rows], c[rows])

    def grow(entry: tuple[int, Iterable[tuple]]) -> tuple[int, bytes]:
        i, pieces = entry
        codes, y, count = (np.concatenate(p) for p in zip(*pieces))
        _, model, number, sizes, _, _, path, d = held.value[i]
        return i, _forest_tree(codes, y, count, sizes, splitter, fill_bins[model], (seed, number), path, d).pack()

    if jobs:
        tasks = max(blocks.context.defaultParallelism, -(-len(jobs) // 64))
        for i, packed in blocks.flatMap(parts).groupByKey(tasks).map(grow).collect():  # the trees themselves
            task, node, _ = local[i]
            task.tree.graft(node, Tree.unpack(packed))
    return [Ensemble(layout, fills[m], HeldTrees([t.tree.pack() for t in finished if t.model == m]), 0.0, True) for m in range(models)]


def _stored_forests(blocks: RDD, layout: Layout, fills: Sequence[Fills], folds: int, s: Forest, splitter: Splitter, fill_bins: np.ndarray,
                    jobs: list[tuple[int, int, np.ndarray | None]]) -> list[Ensemble]:
    """Forests whose trees each fit one task: a task has the whole table and some of the trees, which it writes. No tree comes to the driver."""
    tasks, seed = max(2 * blocks.context.defaultParallelism, -(-len(jobs) // JOBS_A_TASK)), s.seed

    def grow(entry: tuple[int, Iterable[Block]]) -> Iterator[tuple[int, int, bytearray]]:
        b = whole_block(entry[1])
        for model, number, sizes in jobs[entry[0]::tasks]:
            c = np.where(in_fold_rows(b, model, folds), bootstrap_counts(b.key, number, seed), 0)
            rows = np.flatnonzero(c)
            tree = _forest_tree(b.codes[rows], b.y[rows], c[rows], sizes, splitter, fill_bins[model], (seed, number), 1, 0)
            yield model, number, bytearray(tree.pack())

    spark = SparkSession.active()
    path = new_path(spark, "forest")
    spark.createDataFrame(with_all_blocks(blocks, tasks).flatMap(grow), TREE_ROWS).write.parquet(path)
    return [Ensemble(layout, f, StoredTrees(path, m, s.trees), 0.0, True) for m, f in enumerate(fills)]


# --- scoring ----------------------------------------------------------------------------------------------------------

def filled_inputs(ensemble: Ensemble) -> list:
    """The ensemble's input columns, with its fills for missing values."""
    fills, layout = ensemble.fills, ensemble.layout
    numbers = [F.coalesce(F.when(~F.isnan(F.col(f"`{n}`").cast("double")), F.col(f"`{n}`").cast("double")), F.lit(float(fills.medians.get(n, 0.0)))).alias(n)
               for n in layout.numeric]
    return numbers + [F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(fills.modes.get(n, ""))).alias(n) for n in layout.categorical]


def shared(ensemble: Ensemble, bare: bool = False) -> Ensemble:
    """The ensemble with its trees in packed form, to be broadcast: the size of the model, not of the table. ``bare``: for scores alone."""
    trees = ensemble.trees
    held = trees.held(bare) if isinstance(trees, StoredTrees) else trees if isinstance(trees, HeldTrees) else HeldTrees([t.pack() for t in trees])
    return replace(ensemble, trees=held)


def spread(df: DataFrame) -> DataFrame:
    """Rows over as many tasks as the cluster has room for: a model costs more than a shuffle of the few bytes it reads."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def scored(df: DataFrame, ensemble: Ensemble, out: str) -> DataFrame:
    """``df`` with the ensemble's margin (boosted) or mean (forest)."""
    held = df.sparkSession.sparkContext.broadcast(shared(ensemble, bare=True))

    def margins(batches: list[np.ndarray]) -> Iterator[pd.Series]:
        found, at = held.value.of_codes(np.concatenate(batches)), 0
        for b in batches:
            yield pd.Series(found[at:at + len(b)])
            at += len(b)

    @F.pandas_udf("double")
    def margin(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        waiting: list[np.ndarray] = []  # trees are unpacked once for some batches
        for batch in batches:
            waiting.append(held.value.layout.codes([x.to_numpy() for x in batch]))
            if sum(map(len, waiting)) >= SCORE_ROWS:
                yield from margins(waiting)
                waiting = []
        if waiting:
            yield from margins(waiting)

    return (spread(df) if ensemble.mean else df).withColumn(out, margin(*filled_inputs(ensemble)))
