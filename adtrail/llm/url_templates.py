"""URL filter by path-template trees (operator 10).

Explicit rules decide first. Every other url gets the verdict of its path
template. The paths of a host form a tree; walking it level by level,
variable segments become wildcards, and frequent sibling branches whose
labelled purity does not differ significantly from that of their siblings are
merged. A template is rejected when its smoothed share of blocked labels is
too high: a host's own counts are smoothed towards the same template over all
hosts, and that towards the overall share. The labels are the explicit rules'
verdicts.

Only DataFrame functions are used. Defined cases: a null url, or one without
``://``, has an empty host and path; repeated pages count as often as they
stand; without any label nothing is rejected; an empty table gives no rows;
columns other than id and url are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.llm import common as C

LEVELS = 3           # deeper segments form one last segment
MIN_SUPPORT = 5      # urls of a literal branch
MIN_SHARE = 0.02     # of its parent's urls
SIMILAR_Z = 1.96     # two-sided 5 %
SMOOTHING = 4.0      # weight of the prior in labelled urls
REJECT = 0.5         # smoothed share of blocked labels


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (UrlRule("org", "/", "allow"), UrlRule("example.org", "/es/", "block"), UrlRule("example.org", "/en/1", "block"),
         UrlRule("com", "/fr/", "allow"), UrlRule("com", "/de/", "block"))


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def match_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest rule that fits, as a struct of name and verdict; else null."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def lexical_segments(path: Column, levels: int = LEVELS) -> Column:
    """Segments with long hexadecimal runs and numbers generalised; what lies
    deeper than ``levels`` is one ``**``."""
    general = F.regexp_replace(F.regexp_replace(_lower(path), r"[0-9a-f]{16,}", "<h>"), r"[0-9]+", "<n>")
    segs = F.filter(F.split(general, "/"), lambda s: s != "")
    return F.when(F.size(segs) > levels, F.concat(F.slice(segs, 1, levels), F.array(F.lit("**")))).otherwise(segs)


def template_tree(paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``host, segs -> template`` with the label counts ``n, labelled,
    blocked``. ``paths``: host, segs, n, labelled, blocked (one row per
    distinct path shape of a host)."""
    counts = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    tree = paths.withColumn("template", F.lit(""))
    for level in range(levels):
        tree = tree.withColumn("seg", F.when(F.size("segs") > level, F.col("segs")[level]))
        branches = C.materialize(tree.where("seg IS NOT NULL").groupBy("host", "template", "seg").agg(*counts), "branches")
        parents = branches.groupBy("host", "template").agg(
            *[F.sum(c).alias("all_" + c) for c in ("n", "labelled", "blocked")])
        both = branches.join(parents, ["host", "template"])
        frequent = (F.col("n") >= MIN_SUPPORT) & (F.col("n") >= MIN_SHARE * F.col("all_n"))
        others = F.col("all_labelled") - F.col("labelled")
        comparable = (F.col("labelled") > 0) & (others > 0)
        p = F.col("all_blocked") / F.col("all_labelled")
        gap = F.abs(F.col("blocked") / F.col("labelled") - (F.col("all_blocked") - F.col("blocked")) / others)
        error = F.sqrt(p * (1 - p) * (1 / F.col("labelled") + 1 / others))
        step = (F.when(~frequent, "*")
                .when(comparable, F.when(gap <= SIMILAR_Z * error, "+").otherwise(F.col("seg")))
                .otherwise(F.col("seg")))
        steps = both.select("host", "template", "seg", step.alias("step"))
        tree = C.materialize(
            tree.join(steps, ["host", "template", "seg"], "left")
            .withColumn("template", F.when(F.col("step").isNull(), F.col("template"))
                        .otherwise(F.concat("template", F.lit("/"), "step"))).drop("seg", "step"), "tree")
    deeper = F.when(F.size("segs") > levels, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))
    return tree.withColumn("template", deeper)


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template, blocked_share``."""
    host, path = host_and_path(F.col(f"`{url_col}`"))
    urls = (pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumn("fit", match_rule(F.col("host"), F.col("path"), rules))
            .withColumn("segs", lexical_segments(F.col("path"))))
    labelled = F.col("fit").isNotNull().cast("long")
    blocked = F.coalesce((F.col("fit.verdict") == "block").cast("long"), F.lit(0))
    shapes = C.materialize(urls.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.sum(labelled).alias("labelled"),
                                                            F.sum(blocked).alias("blocked")), "shapes")
    tree = C.materialize(template_tree(shapes), "templates")
    total = tree.agg(((F.coalesce(F.sum("blocked"), F.lit(0)) + 0.0) / F.greatest(F.coalesce(F.sum("labelled"), F.lit(0)), F.lit(1))).alias("p0"))
    everywhere = (tree.groupBy("template").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")).crossJoin(F.broadcast(total))
                  .select("template", ((F.col("b") + SMOOTHING * F.col("p0")) / (F.col("l") + SMOOTHING)).alias("prior")))
    own = (tree.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
           .join(everywhere, "template")
           .select("host", "template", ((F.col("b") + SMOOTHING * F.col("prior")) / (F.col("l") + SMOOTHING)).alias("blocked_share")))
    judged = C.materialize(tree.select("host", "segs", "template").join(own, ["host", "template"]), "judged")
    return (urls.join(judged, ["host", "segs"])
            .select("page_id", "host", "path", F.col("fit.name").alias("rule"),
                    F.coalesce(F.col("fit.verdict"), F.when(F.col("blocked_share") >= REJECT, "block").otherwise("allow")).alias("verdict"),
                    "template", "blocked_share"))


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(C.table(spark, sf_dir, "pages"))


def _case(rules: tuple[UrlRule, ...], what: str) -> str:
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, what)}'"
        for r in sorted(rules, key=lambda r: -len(r.name)))
    return f"CASE {cases} END"


def _sql() -> str:
    az = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
    ctes = [f"""u AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), {az}) AS host,
      regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
      FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages))""",
            f"""v AS (SELECT *, {_case(RULES, 'name')} AS rule, {_case(RULES, 'verdict')} AS rv,
      list_filter(string_split(regexp_replace(regexp_replace(translate(path, {az}), '[0-9a-f]{{16,}}', '<h>', 'g'), '[0-9]+', '<n>', 'g'), '/'), lambda s: s <> '') AS s0 FROM u)""",
            f"""v2 AS (SELECT *, CASE WHEN len(s0) > {LEVELS} THEN list_append(s0[1:{LEVELS}], '**') ELSE s0 END AS segs FROM v)""",
            """t0 AS (SELECT host, segs, count(*) AS n, count(rv) AS l, count(*) FILTER (rv = 'block') AS b, '' AS t FROM v2 GROUP BY host, segs)"""]
    for k in range(LEVELS):
        ctes.append(f"""b{k} AS (SELECT host, t, segs[{k + 1}] AS seg, sum(n) AS n, sum(l) AS l, sum(b) AS b FROM t{k} WHERE len(segs) > {k} GROUP BY ALL)""")
        ctes.append(f"""s{k} AS (SELECT host, t, seg, CASE WHEN NOT (n >= {MIN_SUPPORT} AND n >= {MIN_SHARE} * an) THEN '*'
      WHEN l > 0 AND al - l > 0 THEN CASE WHEN abs(b / l - (ab - b) / (al - l))
        <= {SIMILAR_Z} * sqrt((ab / al) * (1 - ab / al) * (1 / l + 1 / (al - l))) THEN '+' ELSE seg END ELSE seg END AS step
      FROM (SELECT host, t, seg, n::DOUBLE AS n, l::DOUBLE AS l, b::DOUBLE AS b, (sum(n) OVER w)::DOUBLE AS an, (sum(l) OVER w)::DOUBLE AS al,
            (sum(b) OVER w)::DOUBLE AS ab FROM b{k} WINDOW w AS (PARTITION BY host, t)))""")
        ctes.append(f"""t{k + 1} AS (SELECT x.host, x.segs, x.n, x.l, x.b, CASE WHEN s.step IS NULL THEN x.t ELSE x.t || '/' || s.step END AS t
      FROM t{k} x LEFT JOIN s{k} s ON x.host = s.host AND x.t = s.t AND x.segs[{k + 1}] = s.seg)""")
    ctes.append(f"""f AS (SELECT host, segs, n, l, b, CASE WHEN len(segs) > {LEVELS} THEN t || '/**' ELSE t END AS t FROM t{LEVELS})""")
    ctes.append(f"""g AS (SELECT t, (sum(b)::DOUBLE + {SMOOTHING} * (SELECT sum(b)::DOUBLE / greatest(sum(l), 1) FROM f)) / (sum(l)::DOUBLE + {SMOOTHING}) AS prior FROM f GROUP BY t)""")
    ctes.append(f"""o AS (SELECT host, t, (sum(b)::DOUBLE + {SMOOTHING} * any_value(prior)) / (sum(l)::DOUBLE + {SMOOTHING}) AS share FROM f JOIN g USING (t) GROUP BY host, t)""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT page_id, v2.host, path, rule, coalesce(rv, CASE WHEN share >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       f.t AS template, share AS blocked_share
FROM v2 JOIN f ON v2.host = f.host AND v2.segs = f.segs JOIN o ON f.host = o.host AND f.t = o.t"""


OP10_SQL = _sql()
