"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

The tokens of a document are the hashes of its distinct word n-grams, in one global order: rarest first,
as counted over all documents into a table of fixed size. Two sets that must share c tokens share at least
l within their first size - c + l tokens, for any l. Each document chooses its own l from the estimated cost
of its candidates: a longer prefix meets more postings, but a partner must then share l prefix tokens
instead of one. Two documents are candidates when they share as many as the smaller l of the two asks for.

Links are exact, but pairs are not listed for their own sake. Equal sets are one node. Each node is first
compared with one leader, the node among those it meets whose rare tokens come first in the prefix. What that
links becomes a component, and the join then looks at pairs from different components only: first a node is
held against a component as a whole, and only where a partner may be among its members against these. So a
group of thousands of near copies, and what resembles it without linking, costs as many comparisons, not the
square. No pair that could still join two components is left out.

``link_pairs`` and ``count_links`` give all links as well. A link never leaves its component, so the nodes of
each component are dealt into blocks, and every block meets every other block of the component once, as one
product of matrices. That is exact, and quadratic in the nodes of a component.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ridemart.llm.common import binary_values, checkpointed, few, mix, seeded, stored, word_hashes, word_places

# The table of token counts: 2^SKETCH_BITS numbers, whatever the input. It orders tokens, nothing else.
SKETCH_BITS, BLOCK_BITS = 20, 12
LEVELS = 6
# Estimated cost of comparing two whole sets, in postings read.
COMPARE = 32
# Postings that a token is expected to meet even when the counts say that it is rare.
RARE = 0.5
# Nodes that are sent to every task, at 16 bytes each; beyond that they are joined by a shuffle.
BROADCAST_NODES = 500_000
# Nodes and tokens of a block that is compared as a whole; tokens that are multiplied at a time.
BLOCK_NODES, BLOCK_TOKENS, TOKENS_AT_ONCE = 128, 1 << 17, 4096

_BYTES = np.arange(256, dtype=np.uint8)
_INSIDE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
_FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_FACTORS = seeded(77).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_GAP = b" "
NODE = ("n", "sig")


@dataclass(frozen=True)
class Rule:
    """Two sets link when ``scale`` * intersection >= ``share`` * union; ``words`` make one token."""

    words: int = 4
    share: int = 85
    scale: int = 100

    def least_partner(self, n):
        return -(-self.share * n // self.scale)

    def overlap(self, n, m):
        return -(-self.share * (n + m) // (self.scale + self.share))


def token_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct tokens of each text. A text of fewer words is one token, without words none."""
    data = _FOLD[np.frombuffer(_GAP.join(texts), np.uint8)]
    begins = np.cumsum([0, *(len(text) + len(_GAP) for text in texts)])
    first, last = word_places(data, _INSIDE)
    code = word_hashes(data, first, last)
    bounds = np.searchsorted(first, begins)
    n = len(code) - words + 1
    tokens = np.zeros(max(n, 0), np.uint64)
    for k in range(words):
        tokens += code[k:k + len(tokens)] * _FACTORS[k]
    tokens = mix(tokens)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= words:
            out.append(np.unique(tokens[a:b - words + 1]))
        elif b > a:
            short = np.sum(code[a:b] * _FACTORS[:b - a], dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(tokens: np.ndarray) -> int:
    """64 bits that stand for a set, together with its size."""
    return int(np.sum(mix(tokens ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64).view(np.int64)) if len(tokens) else 0


def _groups(batches: Iterator[pa.RecordBatch], size: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    names, texts, held = [], [], 0
    for batch in batches:
        for name, text in zip(batch.column(0), binary_values(batch.column(1))):
            names.append(name)
            texts.append(text)
            held += len(text)
            if held >= size:
                yield names, texts
                names, texts, held = [], [], 0
    if names:
        yield names, texts


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def _measure(rows: DataFrame, rule: Rule) -> DataFrame:
    """Per document id, n, sig; and the counts of tokens by bucket, one row per task and block of buckets."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["id", "n", "sig", "block", "counts"]
        for ids, texts in _groups(batches):
            sets = token_sets(texts, rule.words)
            counts += np.bincount(_bucket(np.concatenate(sets)), minlength=len(counts))
            none = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array([x.as_py() for x in ids], pa.int64()), pa.array(list(map(len, sets)), pa.int32()),
                pa.array(list(map(signature, sets)), pa.int64()), *none,
            ], names)
        blocks = counts.reshape(-1, 1 << BLOCK_BITS)
        used = np.flatnonzero(blocks.any(axis=1))
        none = pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int32()), pa.nulls(len(used), pa.int64())
        data = [blocks[k].astype("<i8").tobytes() for k in used]
        yield pa.RecordBatch.from_arrays([*none, pa.array(used, pa.int32()), pa.array(data, pa.binary())], names)

    return rows.mapInArrow(measure, "id bigint, n int, sig bigint, block int, counts binary")


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _sketch(measured: DataFrame) -> np.ndarray:
    """All tasks' counts added up: 2^SKETCH_BITS numbers. Each task holds its blocks' sums, not their rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = np.frombuffer(data.as_py(), "<i8")
                total[block] = total[block] + counts if block in total else counts
        yield pa.RecordBatch.from_arrays([
            pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary()),
        ], ["block", "counts"])

    sums = measured.filter("block IS NOT NULL").select("block", "counts").repartition("block").mapInArrow(add, "block int, counts binary")
    out = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.int64)
    for row in sums.collect():
        out[row["block"]] = np.frombuffer(row["counts"], "<i8")
    return out.ravel()


def prefix(tokens: np.ndarray, counts: np.ndarray, usual: float, rule: Rule) -> tuple[np.ndarray, int, int]:
    """The tokens of a set's prefix in the global order, the level l it asks for, and how many serve as index.

    A partner that is not smaller shares more tokens, so that fewer of them need to be found: the index part.
    """
    n = len(tokens)
    seen = counts[_bucket(tokens)]
    order = np.lexsort((tokens, seen))
    need, need_index = int(rule.overlap(n, rule.least_partner(n))), int(rule.overlap(n, n))
    level, best = 1, np.inf
    postings = np.cumsum(np.maximum(seen[order] - usual, RARE))
    for l in range(1, min(LEVELS, need) + 1):
        read = postings[min(n, n - need + l) - 1]
        cost = read + COMPARE * read / l
        if cost < best:
            level, best = l, cost
    return tokens[order[:n - need + level]], level, n - need_index + level


def _postings(rows: DataFrame, counts: np.ndarray, rule: Rule) -> DataFrame:
    """One row per token of each distinct set's prefix: token, sig, place.

    ``place`` packs the size of the set, the place of the token, the level and whether it serves as index.
    """
    shared = rows.sparkSession.sparkContext.broadcast(counts.astype(np.int64))
    usual = counts.mean() + 3 * np.sqrt(counts.mean())

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, done = shared.value, set()
        for _, texts in _groups(batches):
            parts = []
            for tokens in token_sets(texts, rule.words):
                key = (len(tokens), signature(tokens))
                if len(tokens) and key not in done:
                    done.add(key)
                    found, level, index = prefix(tokens, counts, usual, rule)
                    at = np.arange(len(found), dtype=np.int64)
                    place = (np.int64(len(tokens)) << 32) | (at << 4) | (level << 1) | (at < index)
                    parts.append((found.view(np.int64), np.full(len(found), key[1], np.int64), place))
            if parts:
                columns = [pa.array(np.concatenate(x)) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays(columns, ["token", "sig", "place"])

    return rows.select("id", "text").mapInArrow(post, "token bigint, sig bigint, place bigint")


def _sets(rows: DataFrame, rule: Rule) -> DataFrame:
    """The sets themselves: n, sig, tokens."""
    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for _, texts in _groups(batches):
            found = []
            for tokens in token_sets(texts, rule.words):
                key = (len(tokens), signature(tokens))
                if len(tokens) and key not in done:
                    done.add(key)
                    found.append((*key, tokens.view(np.int64)))
            if found:
                n, sig, tokens = zip(*found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(n, pa.int32()), pa.array(sig, pa.int64()),
                    pa.ListArray.from_arrays(np.cumsum([0, *n]).astype(np.int32), np.concatenate(tokens)),
                ], ["n", "sig", "tokens"])

    return rows.mapInArrow(give, "n int, sig bigint, tokens array<bigint>")


def _unpacked(postings: DataFrame) -> DataFrame:
    place = F.col("place")
    return postings.select(
        "token", F.shiftright(place, 32).cast("int").alias("n"), "sig",
        F.shiftright(place.bitwiseAND(0xFFFFFFFF), 4).cast("int").alias("at"),
        F.shiftright(place.bitwiseAND(15), 1).cast("int").alias("level"),
        (place.bitwiseAND(1) == 1).alias("index"),
    )


def _may_link(rule: Rule, na: Column, nb: Column, overlap: Column) -> Column:
    """Length filter, and whether that many shared tokens could do."""
    sizes = rule.scale * F.least(na, nb) >= rule.share * F.greatest(na, nb)
    return sizes & ((rule.scale + rule.share) * overlap.cast("bigint") >= rule.share * (na + nb).cast("bigint"))


def _bound(na: Column, nb: Column, pa_: Column, pb: Column, before: Column) -> Column:
    """The most tokens two sets can share, when they share one at these places and ``before`` earlier ones."""
    return before + 1 + F.least(na - pa_, nb - pb) - 1


def _verified(pairs: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """Of stored pairs (na, sa, nb, sb), those whose whole sets link: a, b as structs.

    Sets are made for the nodes of these pairs only.
    """
    wanted = stored(
        pairs.select(F.col("na").alias("n"), F.col("sa").alias("sig"))
        .unionByName(pairs.select(F.col("nb").alias("n"), F.col("sb").alias("sig"))).distinct(), "nodes",
    )
    if wanted.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    sets = stored(_sets(rows, rule).join(wanted, list(NODE), "left_semi").dropDuplicates(list(NODE)), "sets")

    def side(letter: str) -> DataFrame:
        return sets.select(F.col("n").alias(f"n{letter}"), F.col("sig").alias(f"s{letter}"), F.col("tokens").alias(f"t{letter}"))

    both = pairs.join(side("b"), ["nb", "sb"]).join(side("a"), ["na", "sa"])
    shared = F.size(F.array_intersect("ta", "tb")).cast("bigint")
    linked = (rule.scale + rule.share) * shared >= rule.share * (F.col("na") + F.col("nb")).cast("bigint")
    return both.filter(linked).select(_node("na", "sa").alias("a"), _node("nb", "sb").alias("b"))


def _node(n: str, sig: str) -> Column:
    return F.struct(F.col(n).alias("n"), F.col(sig).alias("sig"))


def components(edges: DataFrame) -> DataFrame:
    """The component of each node of undirected edges (a, b): node, root.

    Every node moves to the neighbour (or itself) of smallest random priority, edges are rewritten, and so
    on until none is left: a logarithmic number of rounds is expected, on chains as well as on stars. A node's
    neighbours are reduced in every task before they meet.
    """
    def priority(name: str) -> Column:
        return F.struct(F.xxhash64(name).alias("rank"), F.col(name).alias("node"))

    labels = None
    edges = checkpointed(edges.filter(F.col("a") != F.col("b")).distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = checkpointed(both.groupBy("a").agg(F.min(priority("b")).alias("best")).select(
            F.col("a").alias("node"), F.least(priority("a"), F.col("best"))["node"].alias("to"),
        ))
        to_a, to_b = (move.select(F.col("node").alias(name), F.col("to").alias(f"to_{name}")) for name in "ab")
        edges = checkpointed(
            edges.join(to_a, "a").join(to_b, "b").filter(F.col("to_a") != F.col("to_b"))
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        )
        if labels is None:
            labels = move.withColumnRenamed("to", "root")
        else:
            labels = labels.join(move.select(F.col("node").alias("root"), "to"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root"),
            )
        labels = checkpointed(labels)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _shared_postings(rows: DataFrame, counts: np.ndarray, rule: Rule) -> DataFrame:
    """The postings whose token more than one node has."""
    postings = _postings(rows, counts, rule)
    several = postings.groupBy("token").agg(
        F.min("sig").alias("least"), F.max("sig").alias("most"), F.max(F.col("place").bitwiseAND(1)).alias("index"),
    ).filter("least <> most AND index = 1").select("token")
    return stored(_unpacked(postings.join(several, "token", "left_semi").distinct()), "postings")


def _ranked(postings: DataFrame) -> DataFrame:
    """With ``rank``, how many of these postings the node has before: no more earlier tokens can be shared."""
    order = Window.partitionBy(*NODE).orderBy("at")
    return postings.withColumn("rank", F.row_number().over(order) - 1)


def _leaders(postings: DataFrame, rule: Rule) -> DataFrame:
    """For each node the leader it shares most prefix tokens with: na, sa, nb, sb."""
    postings = _ranked(postings)
    leader = postings.filter("index").groupBy("token").agg(F.min(F.struct("at", "n", "sig", "rank")).alias("leader"))
    met = postings.join(leader.select("token", "leader.*").toDF("token", "pa", "na", "sa", "ra"), "token")
    na, nb = F.col("na"), F.col("n")
    bound = _bound(na, nb, F.col("pa"), F.col("at"), F.least("ra", "rank"))
    met = met.filter(((na != nb) | (F.col("sa") != F.col("sig"))) & _may_link(rule, na, nb, bound))
    shared = met.groupBy(F.col("n").alias("nb"), F.col("sig").alias("sb"), "na", "sa").agg(
        F.count(F.lit(1)).alias("shared"), F.min("pa").alias("pa"), F.min("at").alias("at"),
        F.min("level").alias("level"),
    ).filter(F.col("shared") >= F.least("level", F.lit(2)))
    # Only what looks like a link is worth it here; nothing is lost, as the join below takes all that stay apart.
    shared = shared.filter(_may_link(rule, F.col("na"), F.col("nb"), _bound(F.col("na"), F.col("nb"), F.col("pa"), F.col("at"), F.lit(0))))
    best = shared.groupBy("nb", "sb").agg(F.max(F.struct("shared", "na", "sa")).alias("best"))
    return best.select("best.na", "best.sa", "nb", "sb")


def _open_postings(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings whose token nodes of different components have, with the component's root and its number of nodes."""
    node = _node("n", "sig")
    known = postings.join(
        labels.select("node.n", "node.sig", F.col("root").alias("known")), list(NODE), "left",
    ).withColumn("root", F.coalesce("known", node)).drop("known")
    apart = known.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most")
    # A pair of different components shares none but these tokens, so ranks count these alone.
    found = _ranked(known.join(apart.select("token"), "token", "left_semi"))
    sizes = labels.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"))
    return stored(found.join(sizes, "root", "left").withColumn("nodes", F.coalesce("nodes", F.lit(1))), "open-postings")


def _open_meetings(known: DataFrame, rule: Rule) -> DataFrame:
    """Nodes and the other components in which a partner may be: n, sig, other (its root).

    A component's postings of one token are one row, so a node costs as many rows as it shares tokens with the
    component, however many nodes that has. Of two components the nodes of the smaller one ask. A node's tokens
    before the first that the component has are in none of its sets, which bounds what they can share.
    """
    whole = known.groupBy("token", "root").agg(
        F.max("nodes").alias("nodes_c"), F.min("level").alias("level_c"), F.min("n").alias("least_c"), F.max("n").alias("most_c"),
        F.max(F.col("n") - F.col("at")).alias("room_c"), F.max("rank").alias("rank_c"),
    ).withColumnRenamed("root", "other")
    n, least, most = F.col("n"), F.col("least_c"), F.col("most_c")
    asks = (F.col("nodes") < F.col("nodes_c")) | ((F.col("nodes") == F.col("nodes_c")) & (F.col("root") < F.col("other")))
    # The partner's size that suits best, and the most tokens that can be shared.
    size = F.least(F.greatest(n, least), most)
    reach = F.least("rank", "rank_c") + F.least(n - F.col("at"), F.col("room_c"))
    fits = (rule.scale * F.least(n, size) >= rule.share * F.greatest(n, size)) & (
        (rule.scale + rule.share) * reach.cast("bigint") >= rule.share * (n + least).cast("bigint")
    )
    met = known.join(whole, "token").filter((F.col("root") != F.col("other")) & asks & fits)
    asked = met.groupBy("n", "sig", "other").agg(
        F.count(F.lit(1)).alias("shared"), F.min(F.least("level", "level_c")).alias("level"), F.min("at").alias("at"),
        F.max("room_c").alias("room"), F.min("least_c").alias("least_c"),
    )
    enough = (rule.scale + rule.share) * F.least(n - F.col("at"), F.col("room")).cast("bigint") >= rule.share * (n + least).cast("bigint")
    return stored(asked.filter((F.col("shared") >= F.col("level")) & enough).select("n", "sig", "other"), "open-meetings")


def _open_pairs(postings: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """All candidates from different components: na, sa, nb, sb, the smaller set first.

    Only components in which a node may have a partner are opened for it.
    """
    known = _open_postings(postings, labels)
    names = ("n", "sig", "at", "level", "rank", "index")
    asking = known.join(_open_meetings(known, rule), list(NODE))
    x = asking.select("token", "other", *(F.col(name).alias(f"{name}_x") for name in names))
    y = known.select("token", F.col("root").alias("other"), *(F.col(name).alias(f"{name}_y") for name in names))
    first = (F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("sig_x") < F.col("sig_y")))
    bound = _bound(F.col("n_x"), F.col("n_y"), F.col("at_x"), F.col("at_y"), F.least("rank_x", "rank_y"))
    index = F.when(first, F.col("index_x")).otherwise(F.col("index_y"))
    met = x.join(y, ["token", "other"]).filter(index & _may_link(rule, F.col("n_x"), F.col("n_y"), bound))
    pairs = met.groupBy("n_x", "sig_x", "n_y", "sig_y").agg(
        F.count(F.lit(1)).alias("shared"), F.min(F.least("level_x", "level_y")).alias("level"),
        F.min("at_x").alias("at_x"), F.min("at_y").alias("at_y"),
    )
    most = _bound(F.col("n_x"), F.col("n_y"), F.col("at_x"), F.col("at_y"), F.lit(0))
    enough = (F.col("shared") >= F.col("level")) & _may_link(rule, F.col("n_x"), F.col("n_y"), most)
    found = pairs.filter(enough)
    return found.select(
        F.when(first, F.col("n_x")).otherwise(F.col("n_y")).alias("na"), F.when(first, F.col("sig_x")).otherwise(F.col("sig_y")).alias("sa"),
        F.when(first, F.col("n_y")).otherwise(F.col("n_x")).alias("nb"), F.when(first, F.col("sig_y")).otherwise(F.col("sig_x")).alias("sb"),
    )


def _linked(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows that were read, their sizes and signatures, and per node its rows, smallest id and component's root."""
    rows = _read(docs, id_col, text_col)
    measured = stored(_measure(rows, rule), "measured")
    counts = _sketch(measured)
    nodes = measured.filter("n > 0 AND block IS NULL").groupBy(*NODE).agg(
        F.min("id").alias("smallest"), F.count(F.lit(1)).alias("rows"),
    )
    postings = _shared_postings(rows, counts, rule)
    links = stored(_verified(stored(_leaders(postings, rule), "leaders"), rows, rule), "leader-links")
    labels = components(links)
    rest = _verified(stored(_open_pairs(postings, labels, rule), "open-pairs"), rows, rule)
    roots = labels.select(F.col("node"), "root")
    rest = stored(rest, "open-links").join(
        roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left",
    ).join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"),
    )
    joined = components(rest).select(F.col("node").alias("first"), F.col("root").alias("second"))
    # First components of nodes, then of those; a node that only the second round linked is its own first.
    first = labels.select("node", F.col("root").alias("first"))
    final = nodes.select(_node("n", "sig").alias("node"), "smallest", "rows").join(first, "node", "left").withColumn(
        "first", F.coalesce("first", "node"),
    ).join(joined, "first", "left").withColumn("root", F.coalesce("second", "first"))
    return rows, measured, final.select("node", "root", "smallest", "rows")


def _with_component(final: DataFrame) -> DataFrame:
    least = final.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return final.join(least, "root").select("node.n", "node.sig", "component_id", F.lit(0).cast("bigint").alias("n_links"))


def _members(measured: DataFrame, named: DataFrame, id_col: str) -> DataFrame:
    members = measured.filter("block IS NULL").select("id", "n", "sig")
    return members.join(named, list(NODE), "left").select(
        F.col("id").alias(id_col), F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        "sig", F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def _blocks(rows: DataFrame, final: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of blocks of one component, each pair once: same, and the nodes of both as structs a, b."""
    final = stored(final.select("node.n", "node.sig", "root", "smallest", "rows"), "linked-nodes")
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES, F.sum("n") / BLOCK_TOKENS)).cast("int")
    sizes = stored(final.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"), parts.alias("parts")).filter("nodes > 1"), "linked-sizes")
    placed = stored(final.join(few(sizes, BROADCAST_NODES), "root").withColumn(
        "part", F.pmod(F.xxhash64("n", "sig"), F.col("parts")).cast("int"),
    ), "placed-nodes")
    wanted = few(placed.select(*NODE), BROADCAST_NODES)
    sets = _sets(rows, rule).join(wanted, list(NODE), "left_semi").dropDuplicates(list(NODE))
    own = sets.join(few(placed, BROADCAST_NODES), list(NODE))
    blocks = stored(own.groupBy("root", "part", "parts").agg(
        F.collect_list(F.struct("n", "sig", "smallest", "rows", "tokens")).alias("a"),
    ), "blocks")
    left = blocks.withColumn("other", F.explode(F.sequence("part", F.col("parts") - 1)))
    right = blocks.select("root", F.col("part").alias("other"), F.col("a").alias("b"))
    return left.join(right, ["root", "other"]).select((F.col("part") == F.col("other")).alias("same"), "a", "b")


def shared_tokens(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many tokens each of some sets shares with each of others: exact, from products of 0/1 matrices."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    total = np.zeros((len(a), len(b)), np.int64)

    def rows(sets: list[np.ndarray], piece: np.ndarray) -> np.ndarray:
        out = np.zeros((len(sets), len(piece)), np.float32)
        for k, tokens in enumerate(sets):
            out[k] = np.isin(piece, tokens, assume_unique=True)
        return out

    for first in range(0, len(both), TOKENS_AT_ONCE):
        piece = both[first:first + TOKENS_AT_ONCE]
        total += (rows(a, piece) @ rows(b, piece).T).astype(np.int64)
    return total


def _compared(blocks: DataFrame, rule: Rule, counts: bool) -> DataFrame:
    """The links between different sets of these blocks, or for each node the rows it links to."""
    side = [("id", "bigint"), ("n", "int"), ("sig", "bigint"), ("rows", "bigint")]
    pairs = ", ".join(f"{name}_{letter} {kind}" for letter in "ab" for name, kind in side) + ", shared bigint"
    kinds = {"int": pa.int32(), "bigint": pa.int64()}

    def columns_of(block: pa.Array) -> tuple[list[pa.Array], list[np.ndarray]]:
        tokens = block.field("tokens")
        sets = [tokens[k].values.to_numpy() for k in range(len(block))]
        return [block.field(name) for name in ("smallest", "n", "sig", "rows")], sets

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column(0)[k].as_py()
                (a, sets_a), (b, sets_b) = (columns_of(batch.column(c)[k].values) for c in (1, 2))
                shared = shared_tokens(sets_a, sets_b)
                na, nb = a[1].to_numpy().astype(np.int64)[:, None], b[1].to_numpy().astype(np.int64)[None]
                linked = (rule.scale + rule.share) * shared >= rule.share * (na + nb)
                if same:
                    linked = np.triu(linked, 1)
                if counts:
                    for own, rows in ((a, linked @ b[3].to_numpy()), (b, a[3].to_numpy() @ linked)):
                        yield pa.RecordBatch.from_arrays([own[1], own[2], pa.array(rows, pa.int64())], ["n", "sig", "met"])
                    continue
                at_a, at_b = np.nonzero(linked)
                found = [x.take(pa.array(at)) for columns, at in ((a, at_a), (b, at_b)) for x in columns]
                names = [x.split()[0] for x in pairs.split(", ")]
                types = [kinds[x.split()[1]] for x in pairs.split(", ")]
                found = [x.cast(kind) for x, kind in zip([*found, pa.array(shared[at_a, at_b])], types)]
                yield pa.RecordBatch.from_arrays(found, names)

    return blocks.mapInArrow(compare, "n int, sig bigint, met bigint" if counts else pairs)


def link_components(
    docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    ``component_id`` is the smallest id reachable by links. NULL and wordless texts have no tokens, link with
    nothing and are their own component; a text of fewer words than a token has is one token. Repeated rows
    and equal texts are linked as equal sets. A NULL id takes part in links; its component is NULL unless
    another member has an id. Ids must be whole numbers. Other columns are ignored. An empty table gives an
    empty result. Tokens are 64-bit hashes.
    """
    _, measured, final = _linked(docs, rule, id_col, text_col)
    return _members(measured, _with_component(final), id_col).drop("sig", "n_links")


def link_pairs(
    docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every link between two different sets, once: id, n, sig and rows of both (``_a``, ``_b``), and shared.

    A set stands for all documents that have it: ``id`` is the smallest of their ids (NULL when none has one),
    ``rows`` their number, ``n`` and ``sig`` name the set as in ``count_links``. Documents of equal sets are
    linked as well, without a row here. The order within a pair says nothing. NULL and wordless texts, repeated
    rows and empty tables are as in ``link_components``.
    """
    rows, _, final = _linked(docs, rule, id_col, text_col)
    return _compared(_blocks(rows, final, rule), rule, counts=False)


def count_links(
    docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """What ``link_components`` gives, with the document's set as ``sig`` (next to n_shingles) and ``n_links``.

    ``n_links`` is the number of other rows that the row links to, those of equal sets included.
    """
    rows, measured, final = _linked(docs, rule, id_col, text_col)
    final = stored(final, "linked")
    met = _compared(_blocks(rows, final, rule), rule, counts=True).groupBy(*NODE).agg(F.sum("met").alias("met"))
    named = _with_component(final).drop("n_links").join(
        final.select("node.n", "node.sig", "rows"), list(NODE),
    ).join(met, list(NODE), "left").withColumn("n_links", F.col("rows") - 1 + F.coalesce("met", F.lit(0)))
    return _members(measured, named.drop("rows", "met"), id_col)


def keep_one(
    docs: DataFrame, rule: Rule = Rule(words=5, share=80), id_col: str = "doc_id", text_col: str = "text",
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """The rows of ``docs`` without all but the smallest id of each component, with all their columns.

    Rows without an id stay, and so do rows that repeat the id that stays.
    """
    linked = link_components(docs, rule, id_col, text_col)
    gone = linked.filter(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias(id_col)).distinct()
    gone = stored(gone, "dropped")
    small = gone.count() <= broadcast_rows
    return docs.join(F.broadcast(gone) if small else gone, id_col, "left_anti").select(*docs.columns)
