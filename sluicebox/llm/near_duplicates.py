"""Near-duplicate documents by an inverted join over the coordinates of MinHash signatures.

Every distinct set of word shingles has a signature; documents with equal sets are one node from the
start. Nodes are posted under each (coordinate, value) pair. Two sets as similar as asked agree in
at least `matches` coordinates (but for a documented chance), so it is enough to meet in the
prefix of each node's postings, rarest first: postings of one node alone are skipped, and a node with
fewer than `matches` shared postings is dropped. Collisions are counted on the packed signatures, and
pairs that have enough are confirmed on the full sets.

A list of many near copies is not expanded into pairs. A shingle that one node alone has is in no
intersection, so the numbers of such shingles bound the similarity of any pair from above; a node
with too many is in no pair, and of two nodes with many each the pair is ruled out. Then every
member is compared with one leader per list, the one with the least share of such shingles first, and
what is confirmed is merged; only members that are not yet in the component of their list's leader
are compared with the rest of the list. No link between components is lost, because two members in
different components cannot both be in the leader's.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sluicebox.llm.common import WordHashes, mixed, shingle_hashes, written
from sluicebox.llm.components import components

COORDINATES = 32
MISS_CHANCE = 1e-6
BATCH_SHINGLES = 300_000

_SIGNATURES = "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, postings array<bigint>"
_SEEDS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64), 5)
_FACTORS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64), 6) | np.uint64(1)


def least_matches(similarity: float, coordinates: int = COORDINATES, miss: float = MISS_CHANCE) -> int:
    """Coordinates in which sets of this similarity agree, but for a chance of at most `miss`."""
    chance, t = 0.0, 0
    while True:
        chance += math.comb(coordinates, t) * similarity**t * (1 - similarity) ** (coordinates - t)
        if chance > miss:
            return max(1, t)
        t += 1


def shingles(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; words are cut at ASCII white space, A-Z as a-z."""
    return np.unique(shingle_hashes(hashes.of((text or "").encode().lower().split()), n))


def _signed(n: int):
    def sign(batches):
        hashes = WordHashes()

        def frame(ids, sets):
            full = [k for k, s in enumerate(sets) if len(s)]
            postings: list = [[]] * len(sets)
            f1, f2 = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            if full:
                joined = np.concatenate([sets[k] for k in full])
                starts = np.cumsum([0] + [len(sets[k]) for k in full[:-1]])
                # a set's fingerprint: sums of two hashes of its shingles
                f1[full] = np.add.reduceat(mixed(joined, 21), starts)
                f2[full] = np.add.reduceat(mixed(joined, 22), starts)
                values = np.empty((len(full), COORDINATES), np.uint64)
                for c in range(COORDINATES):
                    values[:, c] = np.minimum.reduceat((joined ^ _SEEDS[c]) * _FACTORS[c], starts)
                for c in range(COORDINATES):
                    values[:, c] = mixed(values[:, c], 40 + c)
                for k, row in zip(full, values.view(np.int64)):
                    postings[k] = row
            return pd.DataFrame({
                "doc_id": pd.array(ids, "Int64"), "n_shingles": [len(s) for s in sets],
                "f1": f1.view(np.int64), "f2": f2.view(np.int64), "postings": postings,
            })

        for batch in batches:
            ids, sets, held = [], [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = shingles(text, n, hashes)
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                sets.append(found)
                held += len(found)
                if held > BATCH_SHINGLES:
                    yield frame(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield frame(ids, sets)

    return sign


def _sets(n: int):
    def build(batches):
        hashes = WordHashes()
        for batch in batches:
            for first in range(0, len(batch), 500):
                part = batch.iloc[first : first + 500]
                yield pd.DataFrame({"node": part["node"], "shingles": [shingles(t, n, hashes).view(np.int64) for t in part["text"]]})

    return build


# seven coordinates to a number: its highest byte stays free, so that sums of bytes cannot overflow
_PER_NUMBER = 7
_PACKED = -(-COORDINATES // _PER_NUMBER)
_UNUSED = _PACKED * _PER_NUMBER - COORDINATES


def _packed(postings: str) -> list[Column]:
    """The low bytes of all coordinates."""
    byte = lambda c, at: F.shiftleft(F.element_at(postings, c + 1).bitwiseAND(F.lit(255)), 8 * at)
    out = []
    for number in range(_PACKED):
        column = F.lit(0).cast("bigint")
        for at in range(min(_PER_NUMBER, COORDINATES - number * _PER_NUMBER)):
            column = column.bitwiseOR(byte(number * _PER_NUMBER + at, at))
        out.append(column.alias(f"s{number}"))
    return out


def _collisions(a: str, b: str) -> Column:
    """How many bytes of two packed signatures are equal: the zero bytes of their XOR."""
    total = F.lit(-_UNUSED)
    low, high = F.lit(0x007F7F7F7F7F7F7F), F.lit(0x0080808080808080)
    for number in range(_PACKED):
        x = F.col(f"{a}.s{number}").bitwiseXOR(F.col(f"{b}.s{number}"))
        nonzero = (x.bitwiseAND(low) + low).bitwiseOR(x)
        total = total + F.bit_count(F.bitwise_not(nonzero).bitwiseAND(high))
    return total


def _possible(x: str, y: str, percent: int) -> Column:
    """Whether shingles of their own leave two sets room for the asked similarity."""
    own = F.col(f"{x}.own") + F.col(f"{y}.own")
    common = F.least(F.col(f"{x}.n") - F.col(f"{x}.own"), F.col(f"{y}.n") - F.col(f"{y}.own"))
    return common * 100 >= (common + own) * percent


def _sizes(sets: DataFrame, percent: int) -> DataFrame:
    """`node, n, own, light` of the sets that can be in a pair: number of shingles, how many no other
    set has, and whether two such sets can be a pair."""
    single = (
        sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("often"), F.min("node").alias("node")).where("often = 1")
        .groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    )
    sizes = sets.select("node", F.size("shingles").cast("bigint").alias("n")).join(single, "node", "left").select(
        "node", "n", F.coalesce("own", F.lit(0)).alias("own")
    )
    shared = F.col("n") - F.col("own")
    return sizes.where(shared * 100 >= F.col("n") * percent).withColumn("light", shared * 100 >= (F.col("n") + F.col("own")) * percent)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the size of the intersection of their full sets and the sum of their sizes."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b")).cast("bigint")
    both = (F.size("of_a") + F.size("of_b")).cast("bigint")
    return pairs.join(a, "a").join(b, "b").select("a", "b", common.alias("common"), both.alias("both"))


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    """Compared pairs with 100 * intersection >= percent * union."""
    return compared.where(F.col("common") * 100 >= (F.col("both") - F.col("common")) * percent).select("a", "b")


def _beside_leader(lists: DataFrame, leaders: DataFrame, compared: DataFrame, percent: int) -> DataFrame:
    """Adds to each member of a list `shared`, how many shingles it shares with the list's first
    leader, and `loose`, how many it shares with others but not with the leader; leaves out members
    that no member of the list can be linked with.

    Of two members the intersection is at most the smaller `shared` plus the smaller `loose`. Near
    copies whose changes are their own have nothing loose, so those that the leader is not linked
    with find no partner that is as long as the leader.
    """
    with_leader = compared.select(
        F.inline(F.array(F.struct(F.col("a").alias("leader"), F.col("b").alias("node"), "common"),
                         F.struct(F.col("b").alias("leader"), F.col("a").alias("node"), "common")))
    ).distinct()
    first = leaders.select("posting", F.col("node").alias("leader"))
    shared = F.when(F.col("node") == F.col("leader"), F.col("n")).otherwise(F.coalesce("common", "n"))
    known = lists.join(first, "posting").join(with_leader, ["leader", "node"], "left").withColumn("shared", shared)
    known = written(known.withColumn("loose", F.greatest(F.lit(0), F.col("n") - F.col("shared") - F.col("own"))).drop("leader", "common"), "beside-leaders")
    bounds = written(known.groupBy("posting").agg(F.min("n").alias("least_n"), F.max("loose").alias("most_loose")), "list-bounds")
    most = F.col("shared") + F.least("loose", "most_loose")
    able = most * 100 >= (F.col("n") + F.col("least_n") - most) * percent
    return written(known.join(bounds, "posting").where(able).drop("least_n", "most_loose"), "open-lists")


def _possible_beside_leader(x: str, y: str, percent: int) -> Column:
    most = F.least(f"{x}.shared", f"{y}.shared") + F.least(f"{x}.loose", f"{y}.loose")
    return most * 100 >= (F.col(f"{x}.n") + F.col(f"{y}.n") - most) * percent


def _labelled(lists: DataFrame, links: DataFrame | None) -> DataFrame:
    """Lists with each node's component so far; lists of one component are done and left out."""
    if links is None:
        return lists.withColumn("label", F.col("node"))
    known = lists.join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = written(known, "labelled-lists")
    mixed_lists = known.groupBy("posting").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    return known.join(written(mixed_lists.select("posting"), "mixed-lists"), "posting", "left_semi")


def _lists(postings: DataFrame) -> DataFrame:
    """Postings of more than one node."""
    full = postings.groupBy("posting").agg(F.count(F.lit(1)).alias("often")).where("often > 1").select("posting")
    return postings.join(full, "posting", "left_semi")


def _leading(lists: DataFrame, order: Column, turn: int, columns: list[str]) -> DataFrame:
    """Of each list its first node by `order`, then by a hash."""
    first = F.min(F.struct(order.alias("order"), F.xxhash64("node", F.lit(turn)).alias("hash"), "node", "label", *columns))
    return lists.groupBy("posting").agg(first.alias("l")).select("posting", "l.node", "l.label", *[f"l.{c}" for c in columns])


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
    leader_rounds: int = 2,
) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for each row of `docs`.

    Documents are linked if the Jaccard similarity of their sets of `words`-word shingles is at least
    `percent` / 100; a component's id is its smallest document id, and that document is kept. A pair
    at the threshold is missed with a chance of at most `MISS_CHANCE`, more similar ones with less.
    Sets are compared by 64-bit hashes of their shingles.

    Defined results: null and empty texts have no shingles and are linked with nothing; a text of
    fewer words is one shingle; rows without an id are linked with nothing, have no component and
    are kept; rows that share an id are one document; an empty table gives no rows; other columns
    are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = written(rows.mapInPandas(_signed(words), _SIGNATURES), "signatures")
    members = signed.select("doc_id", "n_shingles", "f1", "f2")
    linkable = "doc_id is not null and n_shingles > 0"
    groups = written(members.where(linkable).groupBy("f1", "f2").agg(F.min("doc_id").alias("node")), "equal-sets")
    nodes = groups.select(F.col("node").alias("doc_id"), "f1", "f2")
    posted = written(
        signed.where(linkable).join(nodes, ["doc_id", "f1", "f2"], "left_semi")
        .select(F.col("doc_id").alias("node"), "postings"), "nodes",
    )

    matches = least_matches(percent / 100)
    postings = posted.select("node", F.explode("postings").alias("posting"))
    often = postings.groupBy("posting").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = postings.join(often, "posting")
    by_node = Window.partitionBy("node")
    prefix = (
        shared.withColumns({
            "shared": F.count(F.lit(1)).over(by_node), "place": F.row_number().over(by_node.orderBy("often", "posting")),
        }).where(F.col("place") <= F.col("shared") - matches + 1).select("posting", "node").distinct()
    )
    prefix = written(prefix, "prefixes")
    wanted = _lists(prefix).select("node").distinct()
    sets = written(
        rows.join(wanted, rows["doc_id"] == wanted["node"]).select("node", "text")
        .mapInPandas(_sets(words), "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "shingle-sets",
    )
    able = prefix.join(written(_sizes(sets, percent), "set-sizes"), "node")
    lists = written(_lists(able).join(posted.select("node", *_packed("postings")), "node"), "lists")

    links, beside = None, None
    least_own = F.expr("own * 1000000 div n")
    packed = ["n", "own", *(f"s{n}" for n in range(_PACKED))]
    for turn in range(leader_rounds):
        open_lists = _labelled(lists, links)
        leaders = written(_leading(open_lists, least_own if turn == 0 else F.lit(turn), turn, packed), "leaders")
        pairs = open_lists.alias("x").join(leaders.alias("y"), F.col("x.posting") == F.col("y.posting")).where(
            F.col("x.label") != F.col("y.label")
        )
        if turn:
            pairs = pairs.where(_possible("x", "y", percent) & (_collisions("x", "y") >= matches))
        compared = written(_compared(written(_ordered(pairs), "pairs"), sets), "compared")
        beside = beside or (leaders, compared)
        found = _linked(compared, percent)
        links = written(found if links is None else links.unionByName(found), "links")
    rest = _beside_leader(_labelled(lists, links), *beside, percent)
    leading = written(_leading(rest, least_own, 0, []), "leading")
    # a pair is taken in the first list that both are in, and one of it is light at least
    lists_of = rest.groupBy("node").agg(F.collect_set("posting").alias("lists"))
    labelled = rest.join(leading.select("posting", F.col("label").alias("leading")), "posting").join(lists_of, "node").withColumn(
        "apart", F.col("label") != F.col("leading")
    )
    labelled = written(labelled.drop("leading"), "rest")
    pairs = None
    for x, y, once in (
        (labelled.where("apart"), labelled.where("light"), "not y.apart or not x.light or x.node < y.node"),
        (labelled.where("apart and light"), labelled.where("not light and not apart"), "true"),
    ):
        found = x.alias("x").join(y.alias("y"), F.col("x.posting") == F.col("y.posting")).where(
            (F.col("x.label") != F.col("y.label")) & F.expr(once) & _possible_beside_leader("x", "y", percent)
            & _possible("x", "y", percent) & (_collisions("x", "y") >= matches)
            & (F.array_min(F.array_intersect("x.lists", "y.lists")) == F.col("x.posting"))
        ).select("x.node", F.col("y.node").alias("other"))
        pairs = found if pairs is None else pairs.unionByName(found)
    pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    found = _linked(_compared(written(pairs, "pairs"), sets), percent)
    labels = components(written(links.unionByName(found), "links"))

    labelled = written(
        groups.join(labels, "node", "left").select("f1", "f2", F.coalesce("label", "node").alias("label")), "set-labels"
    )
    joined = members.join(labelled, ["f1", "f2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("label")).alias("label")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
