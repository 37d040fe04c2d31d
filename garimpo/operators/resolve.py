"""Entity resolution: postings of several sources that describe one job.

Rule: two postings match when they fall in the same date window, their titles
reach the title threshold and their companies reach the company threshold.
Postings are taken in a fixed order; each one joins the first earlier leader
it matches, or becomes a leader.  Known jobs are leaders from the start.

The result is exact for any distribution of the data:

1. Postings with the same (window, title, company) are one *node*: they score
   alike against everything, so only the earliest of them counts.
2. Windows with a bounded number of nodes are assigned window by window.
3. Larger windows are cut by company component: a coarsening of "companies
   that reach the threshold", found over distinct names.  A matching pair is
   always inside one component.  Bounded components are assigned as in 2.
4. What is still too large is decided in rounds (see ``_rounds``): the first open
   nodes of a group, a bounded number, are assigned by one task; then all tasks
   compare their shares of the rest with the new leaders.  No group is ever
   held by one task, and no node is compared with anything but leaders.

While titles and companies are few (see ``Limits``), however many nodes have them, each two names are
compared once, before all that: then nodes hold numbers of names, tasks get the list of
near names, and a node meets only leaders whose name is near its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions import fixed_values as V
from ..functions.dates import date_window
from ..functions.similarity import Keys, Near, NearKeys, TextSet, lengths_allow, token_ratio_reaches
from ..functions.text import fold_strip, sort_tokens
from ..session import checkpoint, stored as written

NODE = ["kid", "window", "title_k", "company_k", "forced", "ord"]


class Limits(NamedTuple):
    """Sizes above which a step hands over to the next one."""

    group_nodes: int = 50_000  # nodes one task assigns by itself
    block_companies: int = 200  # names compared pairwise within a signature
    few_companies: int = 200_000  # names up to which two character pairs make a signature, then three
    first_peel: int = 1024  # open nodes of a group that the first round decides; four times as many in each later one
    most_peel: int = 16_384  # and at most so many
    share_nodes: int = 16_384  # nodes of the rest that meet the new leaders in one task
    few_names: int = 100_000  # titles or companies up to which all pairs of them are compared beforehand
    few_pairs: int = 2**24  # pairs of near names up to which every task gets them
    numbered: int = 64  # nodes whose names are numbers take so much less time: rounds are so much larger, shares a quarter of it


# --- nodes --------------------------------------------------------------------
def raw_order(ingested_at: Column, raw_id: Column) -> Column:
    """Sortable text: after all known jobs, newest first, then by id."""
    back = F.lit(4 * 10**18) - F.unix_micros(ingested_at)
    return F.concat(F.lit("1"), F.coalesce(F.lpad(back.cast("string"), 19, "0"), F.lit("0" * 19)), raw_id)


def job_order(created_at: Column, job_id: Column) -> Column:
    """Sortable text: oldest job first, then by id."""
    ahead = F.unix_micros(created_at) + F.lit(10**18)
    return F.concat(F.lit("0"), F.coalesce(F.lpad(ahead.cast("string"), 19, "0"), F.lit("9" * 19)), job_id)


def keyed_postings(
    rows: DataFrame, title: str, company: str, posted_at: str, order: Column, keep: list[str]
) -> DataFrame:
    """Postings with their node key; those without title or company text are left out."""
    normal = rows.select(
        *keep,
        fold_strip(F.col(title)).alias("title_norm"),
        fold_strip(F.col(company)).alias("company_norm"),
        date_window(F.col(posted_at)).alias("window"),
        order.alias("ord"),
    ).filter((F.col("title_norm") != "") & (F.col("company_norm") != ""))
    return normal.withColumns(
        {"title_k": sort_tokens(F.col("title_norm")), "company_k": sort_tokens(F.col("company_norm"))}
    ).withColumn("kid", F.md5(F.concat_ws("\x1f", "window", "title_k", "company_k")))


def nodes(postings: DataFrame, forced: bool) -> DataFrame:
    """One row per distinct key with the order of its earliest posting.

    Repeats collapse before the shuffle, however often a key occurs.
    """
    return (
        postings.groupBy("kid", "window", "title_k", "company_k")
        .agg(F.min("ord").alias("ord"))
        .withColumn("forced", F.lit(forced))
        .select(*NODE)
    )


def merge_nodes(known: DataFrame, new: DataFrame) -> DataFrame:
    """A key that a known job has is a leader; the job's order is the earlier one."""
    return (
        known.unionByName(new)
        .groupBy("kid", "window", "title_k", "company_k")
        .agg(F.max("forced").alias("forced"), F.min("ord").alias("ord"))
        .select(*NODE)
    )


# --- assignment ---------------------------------------------------------------
ASSIGNED = "kid string, leader_kid string"


def assign_leaders(
    all_nodes: DataFrame,
    title_threshold: int = V.TITLE_THRESHOLD,
    company_threshold: int = V.COMPANY_THRESHOLD,
    limits: Limits = Limits(),
) -> DataFrame:
    """(kid, leader_kid) for every node; a leader that matches nothing earlier is its own."""
    if min(title_threshold, company_threshold) <= 80:
        raise ValueError("signatures are lossless for thresholds above 80 only")
    stored = written(all_nodes, "nodes")
    per_window = stored.groupBy("window").agg(F.count(F.lit(1)).alias("_n"))
    titles = _numbered(stored, "title_k", title_threshold, limits)
    companies = titles and _numbered(stored, "company_k", company_threshold, limits)
    if titles and companies:
        stored = companies.of(titles.of(stored)).select(*NODE)
        keys = _near_keys(titles.near, companies.near)
        assign = _numbered_greedy(keys)
        limits = limits._replace(
            first_peel=limits.first_peel * limits.numbered, most_peel=limits.most_peel * limits.numbered,
            share_nodes=limits.share_nodes * max(1, limits.numbered // 4),
        )
    else:
        keys = _text_keys(title_threshold, company_threshold)
        assign = _greedy(keys)

    crowded = per_window.filter(F.col("_n") > limits.group_nodes)
    if crowded.isEmpty():
        return assign(stored, "window")

    sized = stored.join(per_window, "window")
    calm = sized.filter(F.col("_n") <= limits.group_nodes).select(*NODE)
    busy = sized.filter(F.col("_n") > limits.group_nodes).select(*NODE)

    if titles and companies:
        labels = companies.components()
    else:
        labels = company_components(busy.select("company_k").distinct(), company_threshold, limits)
    busy = written(busy.join(labels, "company_k"), "busy")
    per_group = busy.groupBy("window", "component").agg(F.count(F.lit(1)).alias("_n"))
    grouped = busy.join(per_group, ["window", "component"])
    bounded = grouped.filter(F.col("_n") <= limits.group_nodes)
    assigned = assign(calm, "window").unionByName(assign(bounded.select(*NODE, "component"), "window", "component"))
    oversize = grouped.filter(F.col("_n") > limits.group_nodes).drop("_n")
    if oversize.isEmpty():
        return assigned
    return assigned.unionByName(_rounds(oversize, keys, limits))


# Makes the keys of one task, in order, from their titles and companies.
KeysOf = Callable[[pd.Series, pd.Series], Keys | NearKeys]
# Assigns all nodes group by group, the groups being those of the named columns.
Assign = Callable[..., DataFrame]


def _text_keys(title_threshold: int, company_threshold: int) -> KeysOf:
    return lambda titles, companies: Keys(list(titles), list(companies), title_threshold, company_threshold)


def _near_keys(titles: Broadcast, companies: Broadcast) -> KeysOf:
    return lambda t, c: NearKeys(t.to_numpy(), c.to_numpy(), titles.value, companies.value)


def _greedy(keys: KeysOf) -> Assign:
    """Assign the nodes of bounded groups in order."""

    def assign(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ord", ignore_index=True)
        met = keys(group["title_k"], group["company_k"])
        chosen, _ = met.assign(group["forced"].to_numpy(dtype=bool), np.zeros(len(group), dtype=bool))
        kids = group["kid"].to_numpy()
        return pd.DataFrame({"kid": kids, "leader_kid": kids[chosen]})

    return lambda rows, *by: rows.groupBy(*by).applyInPandas(assign, ASSIGNED)


def _numbered_greedy(keys: KeysOf) -> Assign:
    """The same for numbered names; the other columns stay in Arrow."""

    def assign(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, [("ord", "ascending"), ("kid", "ascending")]))
        met = keys(group["title_k"].to_pandas(), group["company_k"].to_pandas())
        chosen, _ = met.assign(group["forced"].to_numpy(), np.zeros(len(group), dtype=bool))
        return pa.table({"kid": group["kid"], "leader_kid": group["kid"].take(pa.array(chosen))})

    return lambda rows, *by: rows.select(*by, "kid", "title_k", "company_k", "forced", "ord").groupBy(*by).applyInArrow(assign, ASSIGNED)


# --- few names ------------------------------------------------------------------
class Numbered(NamedTuple):
    """The different names of a column: their numbers, and which reach which."""

    column: str
    codes: DataFrame  # (column, code)
    near: Broadcast

    def of(self, rows: DataFrame) -> DataFrame:
        """Rows with the name's number in place of the name."""
        return rows.join(F.broadcast(self.codes), self.column).drop(self.column).withColumnRenamed("code", self.column)

    def components(self) -> DataFrame:
        """(number, component), as ``company_components`` has it for names."""
        label = self.near.value.components()
        table = pa.table({self.column: pa.array(np.arange(len(label), dtype=np.int32)), "component": pa.array(label).cast(pa.string())})
        return F.broadcast(self.codes.sparkSession.createDataFrame(table))


def _numbered(nodes_: DataFrame, column: str, threshold: int, limits: Limits) -> Numbered | None:
    """The names of a column, or None where they, their text or their near pairs are too many."""
    names = checkpoint(nodes_.select(column).distinct())
    held = names.agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length(column)).alias("size")).first()
    if held["n"] > limits.few_names or (held["size"] or 0) > 64 * limits.few_names:
        return None
    # By length, so that names whose lengths allow a match lie together.
    texts = sorted((row[0] for row in names.collect()), key=lambda t: (len(t), t))
    pairs = _near_pairs(names.sparkSession, texts, threshold, limits)
    if pairs is None:
        return None
    spark = names.sparkSession
    codes = pa.table({column: pa.array(texts, pa.string()), "code": pa.array(np.arange(len(texts), dtype=np.int32))})
    return Numbered(column, spark.createDataFrame(codes), spark.sparkContext.broadcast(Near(len(texts), *pairs)))


def _near_pairs(spark: SparkSession, texts: list[str], threshold: int, limits: Limits) -> tuple[np.ndarray, np.ndarray] | None:
    """All pairs ``a < b`` of places in ``texts``, which lie by length, that reach the threshold; None if they are too many."""
    rows_, most = 64, limits.few_pairs
    tasks = max(1, min(4 * spark.sparkContext.defaultParallelism, -(-len(texts) // rows_)))
    held = spark.sparkContext.broadcast(texts)

    def compare(batches):
        named = TextSet(held.value)
        far = np.searchsorted(named.sizes, named.sizes * (200 - threshold) // threshold, side="right")
        for batch in batches:
            for task in batch["id"]:
                found, count = [], 0
                for at in range(int(task) * rows_, len(named.texts), tasks * rows_):
                    rows = np.arange(at, min(at + rows_, len(named.texts)))
                    a, b = np.nonzero(named.grid(rows, np.arange(at, far[rows[-1]]), threshold))
                    later = b > a
                    found.append(np.stack((rows[a[later]], at + b[later])).astype(np.int32))
                    count += int(later.sum())
                    if count > 4 * most / tasks + rows_ * len(named.texts):  # too many in all, as tasks have like shares
                        yield pd.DataFrame({"n": [most + 1], "a": [b""], "b": [b""]})
                        return
                ends = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int32)
                yield pd.DataFrame({"n": [count], "a": [ends[0].tobytes()], "b": [ends[1].tobytes()]})

    found = written(spark.range(0, tasks, 1, tasks).mapInPandas(compare, "n long, a binary, b binary"), "pairs")
    if (found.agg(F.sum("n")).first()[0] or 0) > most:
        return None
    ends = [(np.frombuffer(r["a"], dtype=np.int32), np.frombuffer(r["b"], dtype=np.int32)) for r in found.toLocalIterator()]
    return np.concatenate([a for a, _ in ends]), np.concatenate([b for _, b in ends])


# --- signatures ---------------------------------------------------------------
def _gram_ranks(texts: DataFrame, column: str) -> dict[str, int]:
    """Character pairs from rare to frequent.

    Texts are folded to ASCII, so there are at most 128 * 128 pairs to fetch.
    """
    grams = texts.filter(F.char_length(column) >= 2).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.char_length(column) - 1),
                lambda i: F.col(column).substr(i, F.lit(2)),
            )
        ).alias("gram")
    )
    counted = grams.groupBy("gram").count().orderBy("count", "gram").select("gram").collect()
    return {row["gram"]: rank for rank, row in enumerate(counted)}


def sure_pairs(length: float, threshold: int) -> int:
    """How many character pairs a text of this length shares with any text it reaches.

    With edit distance d and S = len1 + len2, two texts share at least
    S/2 - 1 - 1.5 d character pairs (counted with repeats); the threshold bounds
    d, and bounds S from below by the text's own length.
    """
    slack = 1 - threshold / 100
    return int(np.ceil(2 * length / (1 + slack) * (0.5 - 1.5 * slack) - 1 - 1e-9))


def signature_terms(
    text: str, threshold: int, ranks: dict[str, int], degree: int = 1, longest: int = 0, common: int = 1
) -> list[str]:
    """Terms of which two texts that reach the threshold share at least one.

    Above a threshold of 80 one shared character pair is sure, or the texts are
    equal.  So among each text's rarest pairs, all but the sure number less
    one, a common one must be.  Taking ``common - 1`` more makes ``common`` of
    them shared, where that many are sure.  Texts of up to ``longest``
    characters use ``degree`` pairs at once, which is far more selective,
    wherever that many common pairs are sure.
    """
    size, slack = len(text), 1 - threshold / 100
    if size < 2 or slack < 1e-9:
        return ["=" + text]
    sure = sure_pairs(size, threshold)
    seen: dict[str, int] = {}
    grams = []
    for i in range(size - 1):
        gram = text[i : i + 2]
        seen[gram] = seen.get(gram, 0) + 1
        grams.append((ranks.get(gram, -1), f"{gram}{seen[gram]}"))
    rare = [gram for _, gram in sorted(grams)]
    stretch = (1 + slack) / (1 - slack)
    joined = degree > 1 and sure >= degree and size <= longest
    terms = []
    # Partners may be too short or too long for joined pairs; they share a single one.
    if not joined or sure_pairs(size / stretch, threshold) < degree or size * stretch > longest:
        terms += rare[: len(rare) - max(sure, 1) + min(common, max(sure, 1))]
    if joined:
        terms += map("&".join, combinations(rare[: len(rare) - sure + degree], degree))
    return terms


def needed_terms(size: Column, threshold: int, common: int) -> Column:
    """How many of its ``signature_terms`` a text shares at least with a text it reaches."""
    slack = 1 - threshold / 100
    if slack < 1e-9:  # equal texts share their one term
        return F.lit(1)
    sure = F.ceil(size * (2 / (1 + slack) * (0.5 - 1.5 * slack)) - 1 - 1e-9)
    return F.least(F.lit(common), F.greatest(sure, F.lit(1))).cast("int")


def _signatures(
    column: Column, threshold: int, ranks: dict[str, int], degree: int = 1, longest: int = 0, common: int = 1
) -> Column:
    @F.pandas_udf(ArrayType(StringType()))
    def terms(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: signature_terms(t, threshold, ranks, degree, longest, common))

    return terms(column)


# --- company components -------------------------------------------------------
def company_components(
    companies: DataFrame, threshold: int = V.COMPANY_THRESHOLD, limits: Limits = Limits()
) -> DataFrame:
    """(company_k, component): names that reach the threshold share a component.

    Names meet in signature blocks.  In a block of bounded size neighbours in order are
    verified first, then all pairs that those have not tied.  In a larger block every name is tied to the block's first name
    without verification: that only makes components coarser, never wrong, and
    keeps the work linear.
    """
    names = checkpoint(companies.select("company_k"))
    degree = 2 if names.count() <= limits.few_companies else 3
    ranks = _gram_ranks(names, "company_k")
    blocks = checkpoint(
        names.select(
            "company_k",
            F.explode(_signatures(F.col("company_k"), threshold, ranks, degree, 36)).alias("term"),
        )
    )
    sizes = blocks.groupBy("term").agg(
        F.count(F.lit(1)).alias("_n"), F.min("company_k").alias("first")
    ).filter("_n > 1")
    met = blocks.join(sizes, "term")
    small = met.filter(F.col("_n") <= limits.block_companies).select("term", "company_k")

    def verified(some: DataFrame) -> DataFrame:
        near = some.filter(lengths_allow(F.char_length("a"), F.char_length("b"), threshold)).distinct()
        return near.filter(token_ratio_reaches(F.col("a"), F.col("b"), threshold))

    ties = (
        met.filter((F.col("_n") > limits.block_companies) & (F.col("company_k") != F.col("first")))
        .select(F.col("first").alias("a"), F.col("company_k").alias("b"))
        .distinct()
    )
    in_order = Window.partitionBy("term").orderBy("company_k")
    beside = small.select(F.col("company_k").alias("a"), F.lead("company_k").over(in_order).alias("b"))
    known = written(connected(names, verified(beside.filter("b is not null")).unionByName(ties)), "known")
    # Pairs whose names are tied already need no look: only blocks with several components are left.
    placed = small.join(known, "company_k")
    open_ = placed.groupBy("term").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(open_.filter("low <> high").select("term"), "term")
    apart = (
        placed.alias("a")
        .join(placed.alias("b"), "term")
        .filter("a.company_k < b.company_k and a.component <> b.component")
        .select(F.col("a.company_k").alias("a"), F.col("b.company_k").alias("b"))
    )
    tied = known.filter("company_k <> component").select(F.col("component").alias("a"), F.col("company_k").alias("b"))
    return connected(names, verified(apart).unionByName(tied))


def connected(names: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components by smallest label: neighbour step, then label-of-label step."""
    both = checkpoint(edges.union(edges.select("b", "a").toDF("a", "b")))
    labels = checkpoint(both.select(F.col("a").alias("v")).distinct().withColumn("label", F.col("v")))
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("v"))
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, F.col("v") == F.col("a")).select(
            "v", F.least("label", "near").alias("step"), "label"
        )
        jump = stepped.select(F.col("v").alias("_at"), F.col("step").alias("_to"))
        merged = checkpoint(
            stepped.join(jump, F.col("step") == F.col("_at")).select(
                "v", F.col("_to").alias("label"), (F.col("_to") != F.col("label")).alias("moved")
            )
        )
        labels = merged.select("v", "label")
        if merged.filter("moved").isEmpty():
            break
    return names.join(labels, F.col("company_k") == F.col("v"), "left").select(
        "company_k", F.coalesce("label", "company_k").alias("component")
    )


# Signature terms that two matching titles share, where that many are sure.
COMMON_TERMS = 4


# --- rounds for oversize groups -------------------------------------------------
def _few(table: DataFrame, most: int = 100_000) -> DataFrame:
    """A table of one row a group, broadcast if it is as small as that; beyond, joins shuffle."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def _rounds(oversize: DataFrame, keys_of: KeysOf, limits: Limits) -> DataFrame:
    """Assignment of oversize (window, component) groups.

    Nodes get their places in loop order once; from then on a place stands for its node.  A round takes the first open nodes of each
    group up to a bound: all earlier leaders have removed what they match, so the loop
    over these nodes alone finds the next leaders exactly.  The others, dealt in shares
    of bounded size and few titles, meet those leaders in order; one that matches is settled.  Known
    jobs keep the leader they match and stay until they lead themselves.  Comparisons are
    those of the loop, nodes by leaders, split evenly over all tasks whatever the
    distribution; a group of n leaders takes about n / ``most_peel`` rounds.
    """
    kind = oversize.schema["title_k"].dataType.simpleString()
    open_ = f"group string, title_k {kind}, company_k {kind}, forced boolean, pos long, spot long, best long"
    named = oversize.withColumn("group", F.md5(F.concat_ws("\x1f", "window", "component")))
    placed = written(named.orderBy("group", "ord").select(
        "group", "kid", "title_k", "company_k", "forced", F.monotonically_increasing_id().alias("pos")
    ), "placed")
    # ``best`` is the place of the leader, -1 without one.
    rest = placed.drop("kid").withColumns({"spot": F.col("pos"), "best": F.lit(-1).cast("long")})
    if kind == "string":
        # A share is a run of nodes in the order of their titles, so that each title is compared in one or two of them.
        by_title = rest.orderBy("group", "title_k", "pos").withColumn("spot", F.monotonically_increasing_id())
        rest = written(by_title, "rest")
    reach, done, led = limits.first_peel, [], []

    def decide(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos", ignore_index=True)
        keys = keys_of(group["title_k"], group["company_k"])
        settled = group["best"].to_numpy() >= 0
        chosen, leads = keys.assign(group["forced"].to_numpy(dtype=bool), settled)
        group["best"] = np.where(settled, group["best"], group["pos"].to_numpy()[chosen])
        group["leads"] = leads
        return group[["group", "title_k", "company_k", "pos", "best", "leads"]]

    def meet(key: tuple, leaders: pd.DataFrame, nodes_: pd.DataFrame) -> pd.DataFrame:
        if len(leaders) and len(nodes_):
            leaders = leaders.sort_values("pos", ignore_index=True)
            keys = keys_of(*(pd.concat((leaders[c], nodes_[c]), ignore_index=True) for c in ("title_k", "company_k")))
            asking = np.flatnonzero(nodes_["best"].to_numpy() < 0)
            found = keys.first_of(asking + len(leaders), np.arange(len(leaders)))
            best = nodes_["best"].to_numpy(copy=True)
            best[asking[found >= 0]] = leaders["pos"].to_numpy()[found[found >= 0]]
            nodes_ = nodes_.assign(best=best)
        return nodes_[["group", "title_k", "company_k", "forced", "pos", "spot", "best"]]

    share = F.floor(F.col("spot") / limits.share_nodes)
    while True:
        # Blocks of places hold a bounded number of nodes; the first ones that hold enough are decided.
        block = F.floor(F.col("pos") / limits.first_peel)
        held = rest.groupBy("group", block.alias("block")).agg(F.count(F.lit(1)).alias("n"))
        earlier = Window.partitionBy("group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        taken = held.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        now = taken.groupBy("group").agg(
            F.max(F.when(F.col("before") < reach, F.col("block"))).alias("until")
        )
        now = checkpoint(now.join(rest.groupBy("group").agg(F.collect_set(share).alias("shares")), "group"))
        if now.isEmpty():
            break
        marked = rest.join(_few(now), "group").withColumn("early", block <= F.col("until"))
        decided = written(
            marked.filter("early").select("group", "title_k", "company_k", "forced", "pos", "best")
            .groupBy("group").applyInPandas(
                decide, f"group string, title_k {kind}, company_k {kind}, pos long, best long, leads boolean"
            ),
            "decided",
        )
        leaders = decided.filter("leads").select("group", "title_k", "company_k", "pos").join(_few(now), "group")
        shares = leaders.withColumn("share", F.explode("shares")).drop("shares", "until")
        later = marked.filter("not early").withColumn("share", share)
        met = written(
            shares.groupBy("group", "share")
            .cogroup(later.drop("shares", "until", "early").groupBy("group", "share"))
            .applyInPandas(meet, open_),
            "met",
        )
        led.append(decided.filter("leads").select("pos"))
        done += [decided.select("pos", "best"), met.filter("best >= 0 and not forced").select("pos", "best")]
        rest = met.filter("best < 0 or forced")
        reach = min(reach * 4, max(limits.first_peel, limits.most_peel))
    kids = placed.select("pos", "kid")
    leader_kids = kids.join(reduce(DataFrame.union, led), "pos").select(F.col("pos").alias("best"), F.col("kid").alias("leader_kid"))
    return reduce(DataFrame.unionByName, done).join(kids, "pos").join(leader_kids, "best").select("kid", "leader_kid")
