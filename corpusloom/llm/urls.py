"""URL filters: listed rules, and association rules mined by FP-growth for what no list names."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import query, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.01  # share of the labelled urls that show a rule's tokens and verdict together
MIN_CONFIDENCE = 0.8

Rule = tuple[str, str, str]  # host, path from its slash on, verdict


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds host (A-Z lower-cased), path, and tokens to a frame with `url`.

    Tokens: the scheme, every suffix of the host by labels, path segments with
    digits as `#`, names of query parameters, the fragment. A url that is null
    or has no `://` has empty parts and no tokens.
    """
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    step = pages.withColumn("_rest", rest)
    step = step.withColumn("_host", F.regexp_extract("_rest", "^[^/?#]*", 0))
    step = step.withColumn("_tail", F.expr("substring(_rest, length(_host) + 1)"))
    step = step.withColumn("host", F.translate("_host", UPPER, LOWER)).withColumn(
        "path", F.regexp_extract("_tail", "^[^?#]*", 0))
    some = lambda parts: F.filter(parts, lambda x: x != "")
    named = lambda kind, parts: F.transform(parts, lambda x: F.concat(F.lit(f"{kind}:"), x))
    scheme = F.expr("CASE WHEN instr(url, '://') > 1 THEN array(substring(url, 1, instr(url, '://') - 1)) ELSE array() END")
    labels = some(F.split("host", r"\."))
    suffixes = F.transform(labels, lambda x, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    segments = F.transform(some(F.split("path", "/")), lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    asked = F.regexp_extract("_tail", r"^[^?#]*\?([^#]*)", 1)
    names = some(F.transform(F.split(asked, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0)))
    mark = some(F.array(F.regexp_extract("_tail", "^[^#]*#([\\s\\S]*)$", 1)))
    tokens = F.concat(
        named("scheme", F.transform(scheme, lambda x: F.translate(x, UPPER, LOWER))), named("host", suffixes),
        named("path", segments), named("query", names), named("fragment", mark),
    )
    return step.withColumn("tokens", F.array_sort(F.array_distinct(tokens))).drop("_rest", "_host", "_tail")


def listed(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(length, rule, verdict) of the longest rule that fits a host or its subdomains and the path's start; else null."""
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in rules
    ]
    return F.greatest(*fits, F.lit(None).cast("struct<length:int,rule:string,verdict:string>"))


def mined_rules(labelled: DataFrame) -> DataFrame:
    """anchor, antecedent, verdict, confidence, n: rules mined from labelled(tokens, verdict).

    FP-growth finds token sets that come with a verdict in at least MIN_SUPPORT
    of the rows; a rule holds in at least MIN_CONFIDENCE of the rows that show
    its tokens, however many those are. Its anchor is its rarest token, by which
    it is looked up.
    """
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items"))
    items = stored(items)
    if items.isEmpty():
        return labelled.sparkSession.createDataFrame(
            [], "anchor string, antecedent array<string>, verdict string, confidence double, n long")
    model = FPGrowth(itemsCol="items", minSupport=MIN_SUPPORT, minConfidence=MIN_CONFIDENCE).fit(items)
    counts = model.freqItemsets
    is_verdict = lambda x: x.startswith("verdict:")
    sets = counts.select(
        F.array_sort(F.filter("items", lambda x: ~is_verdict(x))).alias("antecedent"),
        F.array_join(F.filter("items", is_verdict), "").alias("said"),
        F.col("freq"),
    ).filter(F.size("antecedent") > 0)
    with_verdict = sets.filter("said <> ''").withColumnRenamed("freq", "n")
    alone = sets.filter("said = ''").select("antecedent", F.col("freq").alias("shown"))
    rules = with_verdict.join(alone, "antecedent").withColumn("confidence", F.col("n") / F.col("shown")).filter(
        F.col("confidence") >= MIN_CONFIDENCE)
    # a rule that one with a token less equals in confidence never decides: that one fits wherever it does, and is seen as often
    shorter = rules.select("antecedent", "said", "confidence", F.explode("antecedent").alias("_t")).select(
        F.array_remove("antecedent", F.col("_t")).alias("_less"), "antecedent", "said", "confidence")
    kept = rules.select(F.col("antecedent").alias("_less"), "said", F.col("confidence").alias("_c"))
    beaten = shorter.join(kept, ["_less", "said"]).filter("_c >= confidence").select("antecedent", "said").distinct()
    rules = rules.join(beaten, ["antecedent", "said"], "left_anti")
    single = counts.filter(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), F.col("freq").alias("seen"))
    each = rules.withColumn("token", F.explode("antecedent")).join(single, "token")
    return stored(
        each.groupBy("antecedent", "said", "confidence", "n").agg(F.min(F.struct("seen", "token")).alias("rare"))
        .select(F.col("rare.token").alias("anchor"), "antecedent",
                F.expr("substring(said, 9)").alias("verdict"), "confidence", "n")
    )


def judged(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    The longest listed rule decides. Urls that the list judges are the labels
    from which token rules are mined, and those judge the others: the rule with
    the highest confidence among the ones whose tokens the url has, then the one
    seen more often, then with fewer tokens, then by text; `default` where none
    fits. Rules are found through an inverted index, by their rarest token.
    Repeated urls are judged once. A null url has empty parts and gets the default.
    """
    parts = with_parts(pages.select(F.col("page_id"), "url"))
    found = parts.withColumn("_l", listed(F.col("host"), F.col("path"), rules))
    labelled = found.filter("_l is not null").select("tokens", F.col("_l.verdict").alias("verdict"))
    index = mined_rules(labelled)
    urls = found.filter("_l is null and size(tokens) > 0").select("url", "tokens").distinct()
    looked = urls.select("url", "tokens", F.explode("tokens").alias("anchor")).join(index, "anchor")
    fits = looked.filter(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = fits.groupBy("url").agg(F.min_by("verdict", F.struct(
        -F.col("confidence"), -F.col("n"), F.size("antecedent"), F.array_join("antecedent", " "), "verdict"
    )).alias("mined")).withColumnRenamed("url", "_url")
    return found.join(best, F.col("url") == F.col("_url"), "left").select(
        "page_id", "host", "path", F.col("_l.rule").alias("rule"),
        F.coalesce("_l.verdict", F.when(F.col("_l").isNull(), F.col("mined")), F.lit(default)).alias("verdict"),
    )


RULES: list[Rule] = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]

OP4_SQL = r"""
WITH RECURSIVE rest AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hosts AS (SELECT *, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (
  SELECT page_id, url, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path, substr(r, length(h) + 1) AS tail FROM hosts),
pieces AS (
  SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels,
    list_filter(string_split(path, '/'), lambda x: x <> '') AS segs,
    list_filter(list_transform(string_split(regexp_extract(tail, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: regexp_extract(x, '^[^=]*')), lambda x: x <> '') AS names,
    regexp_extract(tail, '(?s)^[^#]*#(.*)$', 1) AS mark FROM parts),
toks AS (
  SELECT page_id, url, host, path, list_sort(list_distinct(flatten([
    CASE WHEN strpos(url, '://') > 1 THEN ['scheme:' || translate(substr(url, 1, strpos(url, '://') - 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')] ELSE [] END,
    list_transform(labels, lambda x, i: 'host:' || array_to_string(labels[i:], '.')),
    list_transform(segs, lambda x: 'path:' || regexp_replace(x, '[0-9]+', '#', 'g')),
    list_transform(names, lambda x: 'query:' || x),
    CASE WHEN mark <> '' THEN ['fragment:' || mark] ELSE [] END]))) AS tokens FROM pieces),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
named AS (
  SELECT t.*, (SELECT max(struct_pack(n := length(h || p), rule := h || p, verdict := v)) FROM rules
    WHERE (t.host = h OR ends_with(t.host, '.' || h)) AND starts_with(t.path, p)) AS l FROM toks t),
lab AS (SELECT row_number() OVER () AS id, tokens, l.verdict AS verdict FROM named WHERE l IS NOT NULL),
sub(id, verdict, tokens, a, k) AS (
  SELECT id, verdict, tokens, [tokens[i]], i FROM (SELECT id, verdict, tokens, unnest(range(1, len(tokens) + 1)) AS i FROM lab)
  UNION ALL
  SELECT id, verdict, tokens, list_append(a, tokens[i]), i FROM (SELECT id, verdict, tokens, a, unnest(range(k + 1, len(tokens) + 1)) AS i FROM sub)),
shown AS (SELECT a, count(*) AS c FROM sub GROUP BY a),
mined AS (
  SELECT a, verdict, n, n / c AS confidence FROM (SELECT a, verdict, count(*) AS n FROM sub GROUP BY a, verdict) JOIN shown USING (a)
  WHERE n >= ceil(0.01 * (SELECT count(*) FROM lab)) AND n / c >= 0.8),
best AS (
  SELECT u.url, arg_min(m.verdict, struct_pack(a := -m.confidence, b := -m.n, c := len(m.a), d := array_to_string(m.a, ' '), e := m.verdict)) AS v
  FROM (SELECT DISTINCT url, tokens FROM named WHERE l IS NULL) u JOIN mined m ON list_has_all(u.tokens, m.a) GROUP BY u.url)
SELECT page_id, host, path, l.rule AS rule, coalesce(l.verdict, v, 'allow') AS verdict FROM named LEFT JOIN best USING (url)
"""


@query("op4_url_filter", OP4_SQL)
def op4_url_filter(spark, sf):
    return judged(table(spark, sf, "pages"), RULES)
