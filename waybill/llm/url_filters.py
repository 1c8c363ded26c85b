"""URL filtering by rules and, where no rule fits, by a tree of path templates.

Per host, the path segments form a tree. Digits in a segment become ``#``, so a
child is a shape. A child with few of its node's pages, or one whose labels do
not differ from its siblings' by a chi-square test, is merged into the wildcard
``*``. What is left of a path is its template. A template is rejected when its
labelled pages are mostly bad (a smoothed share) and are at least half of it.
Pages that a rule fits are the labelled ones, as are those with a marked word in
the host (bad).

A rule is ``host/path``: it fits its host and all subdomains if the URL's path
starts with the rule's, the longest rule wins. Rules are a short list, part of
the query, not data.

Defined results: a null URL or one without ``://`` has an empty host and path and
the verdict allow. Segments from ``MAX_DEPTH`` on are one wildcard tail. Repeated
rows give repeated results, an empty table no rows; only the two named columns
of the input are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Words of a host, between characters other than letters, that mark its pages as bad.
MARKED_WORDS = ("adult", "bets", "casino", "pills", "spam")
MAX_DEPTH = 16
#: A child keeps its own branch with at least so many pages and this share of its node's.
LEAST_PAGES = 5
LEAST_SHARE = 0.05
#: Chi-square with two degrees of freedom at 5 %.
DIFFERENT = 5.991
REJECT_FROM = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        rule_host, _, rule_path = rule.partition("/")
        fits = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        found = F.when(fits & F.startswith(path, F.lit("/" + rule_path)), F.lit(rule)).otherwise(found)
    return found


def judge_urls(
    pages: DataFrame,
    rules: dict[str, str] = RULES,
    marked_words: tuple[str, ...] = MARKED_WORDS,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """Per page: its id, ``host``, ``path``, ``rule``, ``verdict``, ``template`` and the template's ``purity``."""
    host, path = host_and_path(pages[url_column])
    judged = pages.select(pages[id_column].alias("id"), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    label = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        label = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(label)
    judged = judged.withColumn("ruled", label)
    marked = F.exists(F.split("host", "[^a-z]+"), lambda word: word.isin(*marked_words))
    bad = F.coalesce(F.col("ruled") == "block", F.lit(False)) | (F.col("ruled").isNull() & marked)
    good = F.coalesce(F.col("ruled") == "allow", F.lit(False))
    segments = F.filter(F.split(F.regexp_replace("path", "[0-9]+", "#"), "/"), lambda s: s != "")
    segments = F.when(F.size(segments) > MAX_DEPTH, F.concat(F.slice(segments, 1, MAX_DEPTH - 1), F.array(F.lit("**")))).otherwise(segments)
    judged = judged.withColumns({"bad": bad.cast("long"), "good": good.cast("long"), "shape": F.array_join(segments, "/")})

    # One row per host and shape from here on: copies of a shape count, but do not travel.
    shapes = judged.groupBy("host", "shape").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    parts = F.split("shape", "/")
    steps = shapes.select("host", "shape", "n", "bad", "good", F.posexplode(parts).alias("depth", "child"), parts.alias("parts"))
    steps = steps.withColumn("node", F.array_join(F.slice("parts", 1, F.col("depth")), "/")).drop("parts")
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    children = steps.groupBy("host", "depth", "node", "child").agg(*counts)
    nodes = children.groupBy("host", "depth", "node").agg(
        F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), F.sum("good").alias("all_good"), F.count("*").alias("branches")
    )
    both = children.join(nodes, ["host", "depth", "node"])

    def distance(own: str, whole: str) -> Column:
        """Chi-square share of one label between a child and its siblings."""
        total, rest = F.col(whole), F.col("all_n") - F.col("n")
        gap = F.col(own) * F.col("all_n") - F.col("n") * total
        return F.when((total > 0) & (rest > 0), gap.cast("double") * gap / (total.cast("double") * F.col("n") * rest)).otherwise(0.0)

    both = both.withColumns({"none": F.col("n") - F.col("bad") - F.col("good"), "all_none": F.col("all_n") - F.col("all_bad") - F.col("all_good")})
    apart = distance("bad", "all_bad") + distance("good", "all_good") + distance("none", "all_none")
    keeps = (F.col("branches") == 1) | ((F.col("n") >= LEAST_PAGES) & (F.col("n") >= LEAST_SHARE * F.col("all_n")) & (apart > DIFFERENT))
    kept = both.select("host", "depth", "node", "child", F.when(keeps, F.col("child")).otherwise("*").alias("token"))
    templates = (
        steps.join(kept, ["host", "depth", "node", "child"])
        .groupBy("host", "shape")
        .agg(F.array_sort(F.collect_list(F.struct("depth", "token"))).alias("tokens"), F.first("n").alias("n"), F.first("bad").alias("bad"), F.first("good").alias("good"))
        .withColumn("template", F.array_join("tokens.token", "/"))
    )
    scored = templates.groupBy("host", "template").agg(*counts)
    labelled = F.col("bad") + F.col("good")
    scored = scored.select(
        "host", "template", ((F.col("bad") + 1) / (labelled + 2)).alias("purity"), (2 * labelled >= F.col("n")).alias("covered")
    )
    verdicts = templates.select("host", "shape", "template").join(scored, ["host", "template"])
    learned = F.when((F.col("purity") >= REJECT_FROM) & F.col("covered"), "block").otherwise("allow")
    return judged.join(verdicts, ["host", "shape"]).select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "template", "purity"
    )


def judge_urls_sql() -> str:
    """The same in DuckDB's SQL, over ``pages``."""
    cases, labels = "NULL", "NULL"
    for rule in sorted(RULES, key=lambda r: (len(r), r)):
        host, _, path = rule.partition("/")
        cases = f"CASE WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{rule}' ELSE {cases} END"
    for rule, verdict in RULES.items():
        labels = f"CASE WHEN rule = '{rule}' THEN '{verdict}' ELSE {labels} END"
    marked = ", ".join(f"'{w}'" for w in MARKED_WORDS)

    def distance(own: str, whole: str) -> str:
        return f"""CASE WHEN {whole} > 0 AND all_n > n
            THEN ({own} * all_n - n * {whole})::DOUBLE * ({own} * all_n - n * {whole}) / ({whole}::DOUBLE * n * (all_n - n)) ELSE 0 END"""

    return f"""
WITH cut AS (SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (SELECT *, {cases} AS rule FROM split),
judged AS (SELECT *, {labels} AS ruled, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'), lambda s: s <> '') AS segments,
    len(list_filter(regexp_split_to_array(host, '[^a-z]+'), lambda w: w IN ({marked}))) > 0 AS marked FROM ruled),
labelled AS (SELECT *, (coalesce(ruled = 'block', false) OR (ruled IS NULL AND marked))::BIGINT AS bad, coalesce(ruled = 'allow', false)::BIGINT AS good,
    array_to_string(CASE WHEN len(segments) > {MAX_DEPTH} THEN list_append(segments[1:{MAX_DEPTH - 1}], '**') ELSE segments END, '/') AS shape FROM judged),
shapes AS (SELECT host, shape, count(*)::BIGINT AS n, sum(bad)::BIGINT AS bad, sum(good)::BIGINT AS good FROM labelled GROUP BY ALL),
parts AS (SELECT *, string_split(shape, '/') AS parts FROM shapes),
steps AS (SELECT host, shape, n, bad, good, depth - 1 AS depth, parts[depth] AS child, array_to_string(parts[1:depth - 1], '/') AS node
    FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS depth FROM parts)),
children AS (SELECT host, depth, node, child, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad, sum(good)::BIGINT AS good FROM steps GROUP BY ALL),
nodes AS (SELECT host, depth, node, sum(n)::BIGINT AS all_n, sum(bad)::BIGINT AS all_bad, sum(good)::BIGINT AS all_good, count(*) AS branches
    FROM children GROUP BY ALL),
joined AS (SELECT *, n - bad - good AS none, all_n - all_bad - all_good AS all_none FROM children JOIN nodes USING (host, depth, node)),
kept AS (SELECT host, depth, node, child, CASE WHEN branches = 1 OR (n >= {LEAST_PAGES} AND n >= {LEAST_SHARE} * all_n
    AND {distance("bad", "all_bad")} + {distance("good", "all_good")} + {distance("none", "all_none")} > {DIFFERENT}) THEN child ELSE '*' END AS token FROM joined),
templates AS (SELECT host, shape, string_agg(token, '/' ORDER BY depth) AS template, first(n) AS n, first(bad) AS bad, first(good) AS good
    FROM steps JOIN kept USING (host, depth, node, child) GROUP BY ALL),
scored AS (SELECT host, template, (sum(bad) + 1)::DOUBLE / (sum(bad) + sum(good) + 2)::DOUBLE AS purity, 2 * (sum(bad) + sum(good)) >= sum(n) AS covered
    FROM templates GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN purity >= {REJECT_FROM} AND covered THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM labelled JOIN templates USING (host, shape) JOIN scored USING (host, template)
"""
