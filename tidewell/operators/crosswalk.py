"""Code crosswalks, the code catalogue and its hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import extract_or_null, icd_chapter, no_nbsp
from tidewell.operators.lookups import map_list
from tidewell.session import cut_lineage

ENTITY_ID = r"/mms/(\d+)"


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def crosswalk(df: DataFrame, key: str, value: str, key_out: str, values_out: str,
              chapters_out: str = "icd11_chapter", chapter: str = "icd11Chapter") -> DataFrame:
    """Sorted distinct values and chapters per key; rows without a value are dropped."""
    return (
        df.filter(_filled(value)).groupBy(F.col(key).alias(key_out))
        .agg(F.array_sort(F.collect_set(value)).alias(values_out),
             F.array_sort(F.collect_set(chapter)).alias(chapters_out))
    )


def nested_crosswalk(multi: DataFrame, one: DataFrame) -> DataFrame:
    """icd10Code -> icd11_codes; one-to-many maps win over one-to-one maps."""
    many = crosswalk(multi, "icd10Code", "icd11Code", "icd10Code", "icd11_codes")
    covered = multi.filter(_filled("icd11Code")).select("icd10Code").distinct()
    rest = one.join(covered, "icd10Code", "left_anti")
    return many.unionByName(crosswalk(rest, "icd10Code", "icd11Code", "icd10Code", "icd11_codes"))


def flat_crosswalk(nested: DataFrame) -> DataFrame:
    """One row per (icd10Code, icd11Code)."""
    return nested.select("icd10Code", F.explode("icd11_codes").alias("icd11Code"), "icd11_chapter")


def reverse_crosswalk(reverse: DataFrame) -> DataFrame:
    """icd11Code -> icd10_codes."""
    return crosswalk(reverse, "icd11Code", "icd10Code", "icd11Code", "icd10_codes")


def build_crosswalk(multi: DataFrame, one: DataFrame,
                    reverse: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nested, flat, reverse) tables."""
    nested = nested_crosswalk(multi, one)
    return nested, flat_crosswalk(nested), reverse_crosswalk(reverse)


def entity_codes(raw: DataFrame) -> DataFrame:
    """(entity_id, icd_code) pairs by the entity number in the uri."""
    return raw.select(extract_or_null(F.col("icd_uri"), ENTITY_ID).alias("entity_id"), "icd_code") \
              .filter(F.col("entity_id").isNotNull()).distinct()


def joined_codes(pairs: DataFrame) -> DataFrame:
    """Codes of an entity as one ``&``-joined text."""
    return pairs.groupBy("entity_id").agg(
        F.array_join(F.array_sort(F.collect_set("icd_code")), "&").alias("icd_code"))


def resolve_exclusions(raw: DataFrame, pairs: DataFrame) -> DataFrame:
    """Aligned exclusion_labels and exclusion_codes per icd_uri (null where unknown)."""
    rows = raw.select("icd_uri", F.posexplode("exclusion").alias("pos", "x")).select(
        "icd_uri", "pos", F.col("x.label").alias("label"),
        extract_or_null(F.col("x.linearization_uri"), ENTITY_ID).alias("entity_id"))
    entries = F.array_sort(F.collect_list(F.struct("pos", "label", "icd_code")))
    return (
        rows.join(joined_codes(pairs), "entity_id", "left").groupBy("icd_uri")
        .agg(entries.alias("e"))
        .select("icd_uri",
                F.transform("e", lambda x: no_nbsp(x["label"])).alias("exclusion_labels"),
                F.transform("e", lambda x: x["icd_code"]).alias("exclusion_codes"))
    )


def build_catalogue(raw: DataFrame) -> DataFrame:
    """Catalogue with exclusions, parents and children resolved to codes, and chapters.

    ``raw`` has one row per ``icd_uri``. Links to entities outside the
    catalogue keep their entity number.
    """
    pairs = entity_codes(raw)
    none = F.array().cast("array<string>")
    linked = raw.join(resolve_exclusions(raw, pairs), "icd_uri", "left")
    for source, out in (("parent_uris", "parent_codes"), ("child_uris", "child_codes")):
        ids = raw.select("icd_uri", F.transform(
            source, lambda u: extract_or_null(u, ENTITY_ID)).alias("ids"))
        links = map_list(ids, "icd_uri", "ids", pairs, "entity_id", "icd_code", out)
        linked = linked.join(links, "icd_uri", "left")
    texts = ["title", "definition", "long_definition", "fully_specified_name"]
    return linked.select(
        "icd_code", "icd_uri", "browser_url", "class_kind",
        *[no_nbsp(F.col(t)).alias(t) for t in texts],
        "inclusion",
        F.transform(F.coalesce("index_terms", none), no_nbsp).alias("index_terms"),
        "foundation_uri",
        F.coalesce("exclusion_labels", none).alias("exclusion_labels"),
        F.coalesce("exclusion_codes", none).alias("exclusion_codes"),
        F.coalesce("parent_codes", none).alias("parent_codes"),
        F.coalesce("child_codes", none).alias("child_codes"),
        icd_chapter(F.col("icd_code")).alias("chapter"),
    )


def _climbed(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, to, steps, done) of nodes with a single parent: ``to`` is the first node above that has none or several, or starts.

    Each round doubles the steps of all pointers, so rounds grow with the
    logarithm of the longest chain. Pointers of a cycle that no start enters
    never arrive: they are still open (not ``done``) after as many rounds as
    the longest possible chain needs.
    """
    above = links.groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("to")).where("n = 1")
    up = cut_lineage(
        above.select(F.col("child").alias("node"), "to").join(starts, "node", "left_anti")
        .select("node", "to", F.lit(1).alias("steps"), F.lit(False).alias("done")))
    longest, reach = up.count(), 1
    while reach <= 2 * longest and not up.where("NOT done").isEmpty():
        # A pointer that meets no other has arrived; one that meets an arrived one arrives with it.
        other = up.select(F.col("node").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("done").alias("_done"))
        moved = up.where("NOT done").join(other, "to", "left").select(
            "node", F.coalesce("_to", "to").alias("to"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"),
            F.coalesce("_done", F.lit(True)).alias("done"))
        up, reach = cut_lineage(up.where("done").unionByName(moved)), 2 * reach
    return up


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, depth) for every node reached from ``roots`` (column ``node``).

    ``edges`` has (parent, child); null ends are left out, cycles and repeated
    edges are allowed. Each node appears once, at its least depth.

    Nodes with a single parent are first tied to where their chain begins, by
    pointers that double their length each round. What is left is the graph of
    nodes with several parents, whose edges carry the steps between them; it is
    walked by rounds that go on from nodes with a new least depth. Rounds grow
    with the logarithm of chains and with the number of such nodes on a path.
    Each round is a written table, so a lost executor costs at most that round.
    """
    links = cut_lineage(edges.where("parent IS NOT NULL AND child IS NOT NULL AND parent != child").select("parent", "child").distinct())
    starts = cut_lineage(roots.where("node IS NOT NULL").select("node").distinct())
    up = _climbed(links, starts)
    joints = links.groupBy("child").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("child") \
        .join(starts.withColumnRenamed("node", "child"), "child", "left_anti")
    # An edge into a joint begins where its parent's chain begins; chains that arrive nowhere are left out.
    bridges = cut_lineage(
        links.join(joints, "child", "left_semi").join(up.withColumnRenamed("node", "parent"), "parent", "left")
        .where("done IS NULL OR done")
        .groupBy(F.coalesce("to", "parent").alias("parent"), "child").agg(F.min(F.coalesce("steps", F.lit(0)) + 1).alias("steps")))
    fresh = starts.withColumn("depth", F.lit(0))
    depths = fresh
    while True:
        step = (
            bridges.join(fresh.withColumnRenamed("node", "parent"), "parent")
            .groupBy(F.col("child").alias("node")).agg(F.min(F.col("depth") + F.col("steps")).alias("depth"))
            .join(depths.withColumnRenamed("depth", "_least"), "node", "left")
            .where("_least IS NULL OR depth < _least").drop("_least")
        )
        fresh = cut_lineage(step)
        if fresh.isEmpty():
            break
        depths = cut_lineage(depths.join(fresh, "node", "left_anti").unionByName(fresh))
    below = up.where("done").join(depths.withColumnRenamed("node", "to"), "to")
    return depths.unionByName(below.select("node", (F.col("depth") + F.col("steps")).alias("depth")))


def reachable_of_kind(edges: DataFrame, roots: DataFrame, kinds: DataFrame,
                      wanted: tuple[str, ...] = ("category",)) -> DataFrame:
    """Reached nodes whose ``class_kind`` (in ``kinds``: node, class_kind) is wanted."""
    chosen = kinds.filter(F.col("class_kind").isin(*wanted)).select("node", "class_kind")
    return reachable(edges, roots).join(chosen, "node")
