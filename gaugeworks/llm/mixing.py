"""Mix sources to target weights over a domain-language-source tree.

Budgets go down the tree. At each node the budget is shared among the children by
weight; a child whose supply is smaller keeps its supply and the shortage goes to
its siblings, and only what a whole subtree cannot fill goes to its parent's
siblings. A leaf fills its budget with whole epochs and then with the first tokens
of one more epoch in a seeded order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import WORD, query, table
from gaugeworks.session import materialize

LEVELS = ["domain", "lang", "source"]

# Sources of each domain; others are "other".
DOMAINS = {
    "web": ["src0", "src1", "src2", "src3", "src4"],
    "books": ["src5", "src6", "src7", "src8", "src9"],
    "news": ["src10", "src11", "src12", "src13", "src14"],
    "talk": ["src15", "src16", "src17", "src18", "src19"],
}
# Relative weights among siblings; names that are not listed weigh 1.
WEIGHTS = {
    "domain": {"web": 4, "books": 3, "news": 2, "talk": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {},
}
MAX_EPOCHS = 3
SEED = 17
# Hex digits of the seeded key that name a bucket: 4096 buckets a leaf.
BUCKET_DIGITS = 3


def domain_of(source: Column, domains: dict[str, list[str]] = DOMAINS) -> Column:
    found = [F.when(source.isin(*names), F.lit(d)) for d, names in domains.items() if names]
    return F.coalesce(*found, F.lit("other"))


def _weight(name: Column, weights: dict[str, int]) -> Column:
    named = [F.when(name == k, F.lit(w)) for k, w in weights.items()]
    return F.coalesce(*named, F.lit(1)).cast("long")


def _key(seed: int, epoch: Column, doc_id: Column, text_md5: Column) -> Column:
    """A document's place in the order of an epoch."""
    unknown = F.lit("null")
    shown = F.coalesce(doc_id.cast("string"), unknown)
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), shown, F.coalesce(text_md5, unknown)))


def share(nodes: DataFrame, parents: list[str], child: str, weights: dict[str, int]) -> DataFrame:
    """Give each child of a node its part of the node's `budget` as `given`.

    `nodes` has one row per child with its supply `cap`. Children are filled in the
    order of supply by weight: those below the common level are full, the others get
    the level times their weight. Children of weight 0 get nothing.
    """
    nodes = nodes.withColumn("weight", _weight(F.col(child), weights))
    group = Window.partitionBy(*parents)
    order = group.orderBy(F.col("ratio").asc(), F.col(child).asc_nulls_first())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(0.0))
    nodes = nodes.withColumn("usable", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0))
    nodes = nodes.select(
        "*",
        F.row_number().over(order).alias("nth"),
        F.coalesce(F.sum("usable").over(earlier), F.lit(0)).alias("cap_before"),
        (F.sum("weight").over(group) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("weight_left"),
    )
    room = (F.col("budget") - F.col("cap_before")).cast("double")
    nodes = nodes.withColumn("level", F.when(F.col("weight_left") > 0, room / F.col("weight_left")).otherwise(0.0))
    short = F.when((F.col("weight") > 0) & (F.col("ratio") > F.col("level")), F.struct("nth", "level"))
    nodes = nodes.withColumn("open", F.min(short).over(group))
    full = F.col("open").isNull() | (F.col("nth") < F.col("open.nth"))
    given = F.when(full, F.col("usable")).otherwise(F.floor(F.greatest(F.col("open.level"), F.lit(0.0)) * F.col("weight")))
    return nodes.withColumn("given", given.cast("long"))


def leaf_budgets(leaves: DataFrame, budget: Column, max_epochs: int, weights: dict[str, dict[str, int]]) -> DataFrame:
    """`leaves` (domain, lang, source, supply) with `given`, `epochs` (whole ones) and `rest`."""
    tree = leaves.withColumn("cap", F.col("supply") * max_epochs)
    above, parents = None, []
    for i, level in enumerate(LEVELS):
        own = LEVELS[: i + 1]
        nodes = tree.groupBy(*own).agg(F.sum("cap").alias("cap"), F.sum("supply").alias("supply"))
        if above is None:
            nodes = nodes.withColumn("budget", budget)
        else:
            same = [nodes[c].eqNullSafe(above[c]) for c in parents]
            nodes = nodes.join(above, same).select(*[nodes[c] for c in nodes.columns], above["given"].alias("budget"))
        shared = share(nodes, parents, level, weights.get(level, {}))
        above, parents = shared.select(*own, "given", "supply"), own
    whole = F.when(F.col("supply") > 0, F.expr("given div supply")).otherwise(0).cast("int")
    return above.withColumn("epochs", whole).withColumn("rest", F.col("given") - F.col("epochs") * F.col("supply"))


def measured(docs: DataFrame, domains: dict[str, list[str]] = DOMAINS) -> DataFrame:
    """doc_id, domain, lang, source, text_md5 and tokens (words of the whole text), written once."""
    text = F.col("text")
    return materialize(
        docs.select(
            "doc_id",
            domain_of(F.col("source"), domains).alias("domain"),
            "lang",
            "source",
            F.md5(text).alias("text_md5"),
            F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        ),
        "mix-tokens",
    )


def mix_plan(
    sized: DataFrame,
    budget_share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    weights: dict[str, dict[str, int]] = WEIGHTS,
) -> DataFrame:
    """One row per leaf: budget `given`, whole `epochs`, `rest` and `last_key`.

    `last_key` is the key of the last document that the unfinished epoch takes
    (null: none). It is found from totals of key buckets; only the one bucket in
    which the budget ends is put in order, so a leaf with very many documents is
    never in one task.
    """
    leaves = sized.groupBy(*LEVELS).agg(F.sum("tokens").alias("supply"))
    all_tokens = F.sum("supply").over(Window.partitionBy())
    budgeted = leaves.withColumn("total", F.floor(all_tokens * budget_share))
    total = budgeted.agg(F.coalesce(F.max("total"), F.lit(0)).alias("t")).first().t
    plan = materialize(leaf_budgets(leaves, F.lit(total).cast("long"), max_epochs, weights), "mix-budgets")

    names = [F.col(f"s.{c}").eqNullSafe(F.col(f"p.{c}")) for c in LEVELS]
    asked = plan.filter("rest > 0")
    keyed = (
        sized.alias("s")
        .join(asked.alias("p"), names)
        .select("p.*", "s.tokens", _key(seed, F.col("p.epochs"), F.col("s.doc_id"), F.col("s.text_md5")).alias("key"))
    )
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    sums = keyed.groupBy(*LEVELS, "rest", bucket.alias("bucket")).agg(F.sum("tokens").alias("n"))
    earlier = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ends = sums.filter("before < rest").groupBy(*LEVELS).agg(F.max(F.struct("bucket", "before")).alias("end"))
    ends = ends.select(*LEVELS, F.col("end.bucket").alias("end_bucket"), F.col("end.before").alias("before"))
    near = (
        keyed.alias("s")
        .join(ends.alias("p"), [*names, bucket == F.col("p.end_bucket")])
        .groupBy(*[F.col(f"s.{c}") for c in LEVELS], "rest", "before", "key")
        .agg(F.sum("tokens").alias("n"))
    )
    inside = Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    last = near.withColumn("start", start).filter("start < rest").groupBy(*LEVELS).agg(F.max("key").alias("last_key"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"e.{c}")) for c in LEVELS]
    return materialize(plan.alias("p").join(last.alias("e"), same, "left").select("p.*", "e.last_key"), "mix-plan")


def _chosen(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """`rows` (with the leaf, doc_id, text_md5) once for each epoch that takes them, with `epoch`."""
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"p.{c}")) for c in LEVELS]
    key = _key(seed, F.col("p.epochs"), F.col("s.doc_id"), F.col("s.text_md5"))
    joined = rows.alias("s").join(plan.alias("p"), same).withColumn("more", F.coalesce(key <= F.col("last_key"), F.lit(False)))
    times = F.col("p.epochs") + F.col("more").cast("int")
    taken = joined.withColumn("times", times).filter("times > 0")
    return taken.select("s.*", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"))


def mix(
    docs: DataFrame,
    budget_share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    domains: dict[str, list[str]] = DOMAINS,
    weights: dict[str, dict[str, int]] = WEIGHTS,
) -> DataFrame:
    """One row per document and epoch that takes it: doc_id, domain, lang, source, epoch, tokens.

    The budget is `budget_share` of all tokens (words of the whole text). No leaf
    gives more than `max_epochs` times its tokens, so the result is smaller than the
    budget only if all leaves are used up (or by rounding down, one token a node).
    The last document of a leaf is the one in which the budget ends. Null languages
    or sources are leaves of their own; null or empty texts have no tokens and come
    with their neighbours in the order; rows with the same id and text are taken
    together. Equal keys do not occur otherwise. An empty table gives no rows.
    """
    sized = measured(docs, domains)
    plan = mix_plan(sized, budget_share, max_epochs, seed, weights)
    return _chosen(sized, plan, seed).select("doc_id", *LEVELS, "epoch", "tokens")


def mixed_documents(
    docs: DataFrame,
    budget_share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    domains: dict[str, list[str]] = DOMAINS,
    weights: dict[str, dict[str, int]] = WEIGHTS,
) -> DataFrame:
    """The columns of `docs`, each document as often as `mix` takes it."""
    plan = mix_plan(measured(docs, domains), budget_share, max_epochs, seed, weights)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id",
        domain_of(F.col("source"), domains).alias("domain"),
        "lang",
        "source",
        F.md5("text").alias("text_md5"),
    )
    return _chosen(rows, plan, seed).select("row.*")


def _sql_weight(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {w}" for k, w in WEIGHTS[level].items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


def _sql_share(name: str, source: str, level: str, parents: str) -> str:
    by = f"PARTITION BY {parents}" if parents else ""
    return f"""
{name}_a AS (SELECT *, {_sql_weight(level)} AS weight, cap / ({_sql_weight(level)}) AS ratio FROM {source}),
{name}_b AS (SELECT *, row_number() OVER o AS nth,
    (budget - coalesce(sum(cap) OVER e, 0)) / (sum(weight) OVER g - coalesce(sum(weight) OVER e, 0)) AS level
  FROM {name}_a WINDOW g AS ({by}), o AS ({by} ORDER BY ratio, {level} NULLS FIRST),
    e AS ({by} ORDER BY ratio, {level} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{name}_c AS (SELECT *, min(nth) FILTER (ratio > level) OVER g AS open_nth,
    arg_min(level, nth) FILTER (ratio > level) OVER g AS open_level FROM {name}_b WINDOW g AS ({by})),
{name} AS (SELECT * EXCLUDE (level), CASE WHEN open_nth IS NULL OR nth < open_nth THEN cap
    ELSE floor(open_level * weight) END::BIGINT AS given FROM {name}_c)"""


_SQL_DOMAIN = "CASE " + " ".join(
    f"WHEN source IN ({', '.join(repr(s) for s in names)}) THEN '{d}'" for d, names in DOMAINS.items()
) + " ELSE 'other' END"

OP3_SQL = f"""
WITH sized AS (
  SELECT doc_id, {_SQL_DOMAIN} AS domain, lang, source, md5(text) AS text_md5,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS supply, sum(tokens)::BIGINT * {MAX_EPOCHS} AS cap
  FROM sized GROUP BY ALL),
n1 AS (SELECT domain, sum(cap)::BIGINT AS cap, (SELECT sum(supply)::BIGINT FROM leaves) AS budget
  FROM leaves GROUP BY domain),{_sql_share("d", "n1", "domain", "")},
n2 AS (SELECT l.domain, l.lang, sum(l.cap)::BIGINT AS cap, any_value(d.given) AS budget
  FROM leaves l JOIN d ON l.domain = d.domain GROUP BY l.domain, l.lang),{_sql_share("g", "n2", "lang", "domain")},
n3 AS (SELECT l.*, g.given AS budget FROM leaves l
  JOIN g ON l.domain = g.domain AND l.lang IS NOT DISTINCT FROM g.lang),
{_sql_share("s", "n3", "source", "domain, lang").lstrip()},
plan AS (SELECT *, CASE WHEN supply > 0 THEN given // supply ELSE 0 END AS epochs FROM s),
keyed AS (
  SELECT z.*, p.epochs, p.given - p.epochs * p.supply AS rest,
         md5(concat_ws(':', {SEED}, p.epochs, coalesce(z.doc_id::VARCHAR, 'null'), coalesce(z.text_md5, 'null'))) AS key
  FROM sized z JOIN plan p ON z.domain = p.domain AND z.lang IS NOT DISTINCT FROM p.lang
    AND z.source IS NOT DISTINCT FROM p.source),
placed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS start FROM keyed),
timed AS (SELECT *, epochs + (start < rest)::INT AS times FROM placed)
SELECT doc_id, domain, lang, source, unnest(range(times)) AS epoch, tokens FROM timed
"""


@query("op3_mixing", OP3_SQL)
def op3_mixing(spark, folder):
    """All documents mixed to the target weights, with as many tokens as the corpus has."""
    return mix(table(spark, folder, "documents"))
