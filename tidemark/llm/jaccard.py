"""Documents whose sets of n-word shingles have a Jaccard similarity of at least ``percent`` / 100, joined exactly.

1. Equal sets are collapsed: one set, named by its digest, stands for all its documents.
2. Sets that may link meet in groups. The sets of a size class differ in at most k shingles when they link, so of
   k + 1 parts into which a hash deals the shingles, one is the same on both sides. A part's hash is a group's token.
   There are some more parts than that, and a set leaves out as many, its smallest ones: a part of one or two shingles
   is equal in many texts that share no more than a passage. (Groups by shared rare shingles instead held every two
   documents that share a passage; figures in the README.)
3. Tokens with the same sets are one token. Sets meet first only by the smallest token that they share with any other,
   which already joins most near copies. While that joins a good part of what is left, a few sets of each component meet
   the sets still alone, each of those by one open token. Then all sets meet that open tokens tie together, whose sets
   are not yet in one component.
4. A set's sketch is the parity of its shingles in each of at least 2 n bits: two sets differ in at least as many
   shingles as their sketches in bits. A set whose sketch is too far from those of all sets of other components in its
   group links with none of them and leaves the group before texts are fetched.
5. A group is joined by a trie of the sets left, each in the global order of hashes: the traversal carries the overlap of
   shared paths and leaves out subtrees whose set sizes and remaining lengths cannot reach the overlap that a link
   needs, and subtrees of the probe's own component. The largest component of a group is dealt into blocks of ``BLOCK``
   sets and the other sets meet every block; more other sets than ``BLOCK`` are joined block against block.
6. The links that join components give the connected components by repeated spreading of the smallest digest; a
   component is then named by its smallest doc_id.

Null texts and texts without words have an empty set and are linked with nothing. Fewer words than n give one shingle.
Rows are documents of their own, also under a repeated or null doc_id: a doc_id with two texts may stand in two
components. A component of null doc_ids alone has a null id. Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import lower_ascii, mix, modest_batches, table, window_hashes, word_hashes, word_spans
from tidemark.session import settle

SLACK, SLACK_SHARE = 4, 8  # parts above k + 1: so many at least, and one for so many of k
BLOCK = 2000

_SKETCH = np.uint64(0x94D049BB133111EB)


def shingles(text: str | None, n: int = 4) -> np.ndarray:
    """Distinct shingle hashes, ascending; words are lower-cased in A-Z."""
    raw = lower_ascii((text or "").encode())
    words = word_hashes(raw, *word_spans(raw))
    return np.unique(window_hashes(words, min(n, len(words)))) if len(words) else np.zeros(0, np.uint64)


def needed(a: int, b: int, percent: int) -> int:
    """Overlap from which sets of sizes a and b link: percent * union <= 100 * overlap."""
    return -(-percent * (a + b) // (100 + percent))


def size_class(n: int, percent: int) -> tuple[int, int]:
    """Smallest and largest size of the class of ``n``: classes span two steps of the size ratio of linking sets."""
    low = 1
    while (high := max(low, low * 10000 // (percent * percent))) < n:
        low = high + 1
    return low, high


def parts(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(largest size of the class, k, number of parts) of the schemes that a set of ``n`` takes part in.

    A pair belongs to the class of its smaller set, so a set also serves the class below if sets there can link with it.
    """
    low, high = size_class(n, percent)
    classes = [high]
    if low > 1 and percent * n <= 100 * (low - 1):
        classes.append(low - 1)
    out = []
    for most in classes:
        k = most * (100 - percent) // percent
        out.append((most, k, k + 1 + min(k, max(SLACK, k // SLACK_SHARE))))
    return out


def tokens(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of the parts of a set, less the m - k - 1 smallest parts of each scheme.

    Linking sets have m - k equal parts. Parts are ordered by size and token, which are the same on both sides, so the
    last of the equal parts has m - k - 1 others before it in either set and is left out in neither.
    """
    out = []
    for most, k, m in parts(len(hashes), percent):
        own = mix(hashes + np.uint64(most))
        part = (own % np.uint64(m)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        found, first = np.unique(part[order], return_index=True)
        sums = np.zeros(m, np.uint64)
        sums[found] = np.add.reduceat(mix(own[order]), first)
        made = mix(sums ^ mix(np.uint64(most) * np.uint64(1 << 20) + np.arange(m, dtype=np.uint64)))
        out.append(made[np.lexsort((made, np.bincount(part, minlength=m)))[m - k - 1:]])
    return np.unique(np.concatenate(out))


@dataclass
class Node:
    """A path of the trie: ``label`` is its part of the sets below; sizes and components are those of the sets below."""

    label: tuple
    members: frozenset
    depth: int  # length up to the end of the label
    least: int
    most: int
    docs: list = field(default_factory=list)
    children: dict = field(default_factory=dict)
    one: int | None = None  # the component of all sets below; None once they were of several


class Trie:
    """Ordered sets by document; documents found to link are joined at once, smallest first."""

    def __init__(self, percent: int, parent: dict) -> None:
        self.percent, self.parent = percent, parent
        self.root = Node((), frozenset(), 0, 1 << 60, 0)

    def find(self, doc):
        while (up := self.parent[doc]) != doc:
            self.parent[doc] = up = self.parent[up]
            doc = up
        return doc

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)

    def insert(self, doc, ordered: tuple) -> None:
        node, at, n = self.root, 0, len(ordered)
        while True:
            if not node.most:
                node.one = doc
            elif node.one is not None and self.find(node.one) != self.find(doc):
                node.one = None
            node.least, node.most = min(node.least, n), max(node.most, n)
            if at == n:
                node.docs.append(doc)
                return
            child = node.children.get(ordered[at])
            if child is None:
                label = ordered[at:]
                node.children[ordered[at]] = Node(label, frozenset(label), n, n, n, [doc], one=doc)
                return
            same = 0
            for x, y in zip(child.label, ordered[at:]):
                if x != y:
                    break
                same += 1
            if same < len(child.label):
                top = Node(child.label[:same], frozenset(child.label[:same]), at + same, child.least, child.most, one=child.one)
                child.label = child.label[same:]
                child.members = frozenset(child.label)
                top.children[child.label[0]] = child
                node.children[ordered[at]] = child = top
            node, at = child, at + same

    def probe(self, doc, ordered: tuple) -> None:
        """Join ``doc`` with every component of the trie that holds a set linking with ``ordered``."""
        mine, n, percent = frozenset(ordered), len(ordered), self.percent
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if node.one is not None and self.find(node.one) == self.find(doc):
                continue
            overlap += len(mine & node.members)
            if node.docs and overlap >= needed(n, node.depth, percent):
                for other in node.docs:
                    if self.find(other) != self.find(doc):
                        self.join(other, doc)
            for child in node.children.values():
                if child.most * 100 < percent * n or child.least * percent > 100 * n:
                    continue
                rest = min(child.most - node.depth, n - overlap)
                if overlap + rest < needed(n, max(child.least, -(-percent * n // 100)), percent):
                    continue
                stack.append((child, overlap))


def join_group(ids: list, component: list, sets: list, percent: int, side: list | None = None) -> list[tuple]:
    """Links between components, (larger, smaller) by component id; with ``side`` only links across sides count."""
    parent = {c: c for c in component}
    trie = Trie(percent, parent)
    order = sorted(range(len(ids)), key=lambda i: (side[i] if side else 0, len(sets[i]), ids[i]))
    for i in order:
        if not side or side[i]:
            trie.probe(component[i], sets[i])
        if not side or not side[i]:
            trie.insert(component[i], sets[i])
    return [(c, trie.find(c)) for c in parent if trie.find(c) != c]


def sketch(s: np.ndarray) -> bytes:
    """Parity of the number of shingles in each bit; bits are a power of two, so halves laid over each other give a shorter one."""
    bits = max(64, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((mix(s + _SKETCH) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def partnered(sizes: np.ndarray, component: np.ndarray, sketches: list[bytes], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Which sets may link with one of another component (and of the other side): sketches differ in few enough bits."""
    out, widths = np.zeros(len(sizes), bool), np.asarray([len(x) for x in sketches])
    for width in np.unique(widths):
        inside = widths == width
        rows = np.flatnonzero(inside | ((widths > width) & (percent * sizes <= 100 * sizes[inside].max())))
        rows = rows[np.lexsort((sizes[rows], ~inside[rows]))]
        folded = np.empty((len(rows), width // 8), np.uint64)
        for k, i in enumerate(rows):
            words = np.frombuffer(sketches[i], np.uint64)
            while len(words) * 8 > width:
                words = words[:len(words) // 2] ^ words[len(words) // 2:]
            folded[k] = words
        for k in range(int(inside.sum())):
            i, others = rows[k], rows[k + 1:]
            both = sizes[i] + sizes[others]
            far = component[others] != component[i]
            if side is not None:
                far &= side[others] != side[i]
            at = np.flatnonzero(far & (100 * np.minimum(sizes[i], sizes[others]) >= percent * np.maximum(sizes[i], sizes[others])))
            apart = np.bitwise_count(folded[k + 1 + at] ^ folded[k]).sum(axis=1, dtype=np.int64)
            near = others[at[apart <= both[at] - 2 * needed(0, both[at], percent)]]
            if len(near):
                out[i] = out[near] = True
    return out


def _sets(docs: DataFrame, columns: list[str], make: Callable, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from make(batch)

    return docs.select(*columns).mapInArrow(run, schema)


def digests(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, 128 bits of the set as two longs and its sketch (null for an empty one)."""
    def make(batch):
        sets = [shingles(t, n) for t in batch.column(2).to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in zip(*map(digest, sets))]
        sketches = pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, sketches],
                                         ["doc_id", "th", "n_shingles", "d", "e", "sketch"])

    return _sets(docs, ["doc_id", "th", "text"], make, "doc_id long, th long, n_shingles long, d long, e long, sketch binary")


def digest(s: np.ndarray) -> tuple:
    if not len(s):
        return 0, None, None
    d, e = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return len(s), int(d.view(np.int64)), int(e.view(np.int64))


def _group_links(members: DataFrame, texts: DataFrame, n: int, percent: int, name: str) -> DataFrame:
    """Links (component, smaller) found inside groups of members (token, set, component); texts has set, text, n_shingles, sketch."""
    parts_ = members.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k"))
    sizes = parts_.groupBy("token").agg(F.sum("k").alias("size"), F.max("k").alias("largest"),
                                        F.max_by("component", "k").alias("big"))
    few = F.col("size") - F.col("largest") <= BLOCK
    blocks = F.when(few, F.ceil(F.col("largest") / BLOCK)).otherwise(F.ceil(F.col("size") / BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def pair(a, b):
        return F.struct(a.alias("a"), b.alias("b"))

    pairs = F.when(~few, F.transform(every, lambda k: pair(F.least(k, F.col("own")), F.greatest(k, F.col("own"))))).when(
        F.col("component") == F.col("big"), F.array(pair(F.col("own"), F.col("own")))).otherwise(
        F.transform(every, lambda k: pair(k, k)))
    spread = members.join(sizes.where("size > largest"), "token").withColumn("blocks", blocks).withColumn("own", own).withColumn(
        "pair", F.explode(pairs)).select("token", "pair.a", "pair.b", "own", "set", "component")

    def select(part: pa.Table) -> pa.Table:
        if part.num_rows < 2:
            return part.slice(0, 0).select(kept)
        a, b = part["a"][0].as_py(), part["b"][0].as_py()
        side = None if a == b else part["own"].to_numpy() == b
        near = partnered(part["n_shingles"].to_numpy(), part["component"].to_numpy(), part["sketch"].to_pylist(), percent, side)
        return part.select(kept).filter(pa.array(near))

    kept = ["token", "a", "b", "own", "set", "component"]
    near = spread.join(texts.select("set", "n_shingles", "sketch"), "set").groupBy("token", "a", "b").applyInArrow(
        select, "token long, a int, b int, own int, set long, component long")
    met = near.join(texts.select("set", "text"), "set")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        a, b = int(part["a"].iloc[0]), int(part["b"].iloc[0])
        sets = [tuple(shingles(t, n).tolist()) for t in part["text"]]
        side = None if a == b else [int(x == b) for x in part["own"]]
        links = join_group(part["set"].tolist(), part["component"].tolist(), sets, percent, side)
        return pd.DataFrame(links, columns=["component", "smaller"]).astype("int64")

    return settle(met.groupBy("token", "a", "b").applyInPandas(run, "component long, smaller long").distinct(), name)


def _open(shared: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(token, set, component, least) of the tokens whose sets are of several components; least is the smallest of these."""
    joined = smallest_reachable(links, "component", "smaller", f"{name}-joined")
    placed = settle(shared.join(joined.withColumnRenamed("node", "set"), "set", "left").select(
        "token", "set", F.coalesce("smallest", "set").alias("component")), f"{name}-placed")
    group = placed.groupBy("token").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    return settle(placed.join(group.select("token", "least"), "token"), f"{name}-open")


def _delegates(open_: DataFrame, step: int) -> DataFrame:
    """Up to four sets of each component of several sets, in each open token; single sets in one open token each."""
    def pick(i):
        return F.min(F.struct(F.xxhash64("set", F.lit(step), F.lit(i)).alias("h"), F.col("set").alias("s")))["s"]

    each = open_.groupBy("token", "component").agg(F.array_distinct(F.array(*[pick(i) for i in range(4)])).alias("sets"),
                                                  F.count(F.lit(1)).alias("k"))
    several = each.where("k > 1").select("token", F.explode("sets").alias("set"), "component")
    alone = each.where("k = 1").groupBy(F.col("sets")[0].alias("set")).agg(
        F.min_by("token", F.xxhash64("token", F.lit(step))).alias("token"), F.first("component").alias("component"))
    return several.unionByName(alone)


def smallest_reachable(links: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """(node, smallest) for every node of the links: labels spread over the links, and over labels, until none changes."""
    edges = settle(links.select(F.col(a).alias("x"), F.col(b).alias("y")).unionByName(
        links.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct(), f"{name}-edges")
    labels = settle(edges.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = edges.join(labels.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("label").alias("near"))
        then = labels.join(near, "x").select("x", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hop = labels.select(F.col("x").alias("label"), F.col("label").alias("far"))
        then = settle(then.join(hop, "label", "left").select("x", "old", F.coalesce("far", "label").alias("label")), f"{name}-{step}")
        done = then.where("old <> label").isEmpty()
        labels = then.select("x", "label")
        if done:
            return labels.select(F.col("x").alias("node"), F.col("label").alias("smallest"))


def components(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, th, n_shingles, component_id, leads of every row of ``docs`` (doc_id, text).

    ``th`` is xxhash64 of the text. ``leads`` marks the rows of one text of each component: the smallest doc_id, then the
    smallest digest and hash. A row with an empty set leads itself.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    sized = settle(digests(docs, n), "digests")
    reps = settle(sized.where("d IS NOT NULL").groupBy("d", "e").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "th")).alias("row"),
        F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch")), "representatives")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task gives the tokens of equal sets once
        for batch in batches:
            found, ids = [], []
            for t in batch.column(0).to_pylist():
                s = shingles(t, n)
                d = digest(s)[1]
                if d is not None and d not in seen:
                    seen.add(d)
                    found.append(tokens(s, percent).view(np.int64))
                    ids.append(np.full(len(found[-1]), d, np.int64))
            flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (found, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in flat], ["token", "set"])

    group = Window.partitionBy("token")
    meeting = settle(docs.select("text").mapInArrow(make, "token long, set long").withColumns({
        "least": F.min("set").over(group), "most": F.max("set").over(group)}).where("least < most").select(
        "token", "set").distinct(), "meeting")
    alike = meeting.groupBy("token").agg(F.bit_xor(F.xxhash64("set")).alias("x"), F.bit_xor(F.xxhash64("set", F.lit(1))).alias("y"),
                                         F.count(F.lit(1)).alias("k")).groupBy("x", "y", "k").agg(F.min("token").alias("token"))
    shared = settle(meeting.join(alike.select("token"), "token", "left_semi"), "shared")
    rows = reps.join(shared.select(F.col("set").alias("d")).distinct(), "d", "left_semi").select(
        F.col("d").alias("set"), F.col("row.doc_id").alias("row_id"), F.col("row.th").alias("row_th"), "n_shingles", "sketch")
    texts = settle(docs.join(rows, F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("th") == F.col("row_th"))).groupBy(
        "set").agg(*[F.first(c).alias(c) for c in ("text", "n_shingles", "sketch")]), "candidates")

    first = shared.groupBy("set").agg(F.min("token").alias("token")).withColumn("component", F.col("set"))
    links = _group_links(first, texts, n, percent, "links-first")
    open_ = _open(shared, links, "first")
    step = 0
    while True:
        step += 1
        more = _group_links(_delegates(open_, step), texts, n, percent, f"links-{step}")
        links = links.unionByName(more)
        had, joined = open_.select("component").distinct().count(), more.select("component").distinct().count()
        if joined:
            open_ = _open(shared, links, f"step-{step}")
        if 10 * joined <= had:
            break
    # Components that open tokens tie together meet once, as a cluster; with many sets outside of its largest component,
    # a cluster meets token by token.
    ties = smallest_reachable(open_.where("component <> least"), "component", "least", "ties")
    members = settle(open_.select("set", "component").distinct().join(ties, F.col("component") == F.col("node")).select(
        F.col("smallest").alias("token"), "set", "component"), "members")
    of_cluster = members.groupBy("token", "component").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(
        (F.sum("k") - F.max("k")).alias("outside"))
    large = settle(of_cluster.where(F.col("outside") > BLOCK).select("token"), "large")
    links = links.unionByName(_group_links(members.join(large, "token", "left_anti"), texts, n, percent, "links-clusters"))
    if not large.isEmpty():
        far = ties.join(large.withColumnRenamed("token", "smallest"), "smallest", "left_semi").select(F.col("node").alias("component"))
        links = links.unionByName(_group_links(open_.drop("least").join(far, "component", "left_semi"), texts, n, percent, "links-tokens"))
    final = smallest_reachable(links, "component", "smaller", "joined")
    placed = settle(reps.join(final, F.col("d") == F.col("node"), "left").select(
        "d", "e", "rep", F.col("row.th").alias("row_th"), F.coalesce("smallest", "d").alias("key")), "placed")
    lead = F.min(F.when(F.col("rep").isNotNull(), F.struct("rep", "d", "e", "row_th")))
    named = placed.join(placed.groupBy("key").agg(lead.alias("lead")), "key").select(
        "d", "e", F.col("lead.rep").alias("component_id"), F.when(F.col("d") == F.col("lead.d"), F.col("lead.row_th")).alias("lead_th"))
    return sized.join(named, ["d", "e"], "left").select(
        "doc_id", "th", "n_shingles", F.when(F.col("d").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("d").isNull() | ((F.col("th") == F.col("lead_th")) & (F.col("doc_id") == F.col("component_id"))),
                   F.lit(False)).alias("leads"))


def op5_trie_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    modest_batches(spark)
    return components(table(spark, sf_dir, "documents")).drop("th", "leads")


#: For the checking engine: the links of all pairs that share a shingle, then the smallest id reachable by links.
OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i : array_to_string(w[i:i+3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""
