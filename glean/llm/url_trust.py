"""URL filters with link-graph propagation.

Rules decide the pages they fit. For the others, trust and distrust flow over the
graph of hosts (an edge where a page of one host links to another host): trust is
personalised PageRank from hosts whose pages the rules allow, along links; distrust
starts at hosts whose pages the rules block and flows against the links, to those who
link to them. A host's seed is the share of its pages; scores are scaled so that a
host without links scores its seed. Rounds go on until all that can still move, summed
over hosts, is at most ``SETTLED``: a round moves at most ``DAMPING`` times what the one
before moved, so the mass of the seeds says after how many rounds that holds. A page without a rule is blocked if its host's
distrust exceeds its trust by more than ``MARGIN``.

Edge cases: null urls and urls without ``://`` have an empty host and path, fit no
rule and are allowed; relative links stay on their host and are no edges; repeated
rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glean.llm.common import save, table, with_columns_of
from glean.llm.registry import query

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING, MARGIN, SETTLED = 0.85, 0.5, 1e-6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def judged_by_rules(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, rule_verdict, html of each row."""
    rest = F.when(F.col("url").contains("://"), F.expr("substr(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    p = pages.withColumn("rest", F.coalesce(rest, F.lit("")))
    p = p.withColumn("host", F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), _UPPER, _LOWER))
    p = p.withColumn("path", F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)).drop("rest")
    best = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for host, path, said in sorted(RULES, key=lambda r: len(r[0] + r[1])):  # a longer one replaces a shorter one
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        best, verdict = F.when(fits, F.lit(host + path)).otherwise(best), F.when(fits, F.lit(said)).otherwise(verdict)
    return p.withColumn("rule", best).withColumn("rule_verdict", verdict)


def host_edges(judged: DataFrame) -> DataFrame:
    """src, dst, links between different hosts."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    links = judged.filter("host <> ''").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    return (links.withColumn("dst", F.translate("dst", _UPPER, _LOWER)).filter("src <> dst and dst <> ''")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def scores(judged: DataFrame) -> DataFrame:
    """host, trust, distrust."""
    seeds = judged.filter("host <> ''").groupBy("host").agg(
        (F.count_if(F.col("rule_verdict") == "allow") / F.count("*")).alias("good"),
        (F.count_if(F.col("rule_verdict") == "block") / F.count("*")).alias("bad"))
    edges = host_edges(judged)
    out = edges.groupBy("src").agg(F.sum("links").alias("n_out"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("n_in"))
    e = save(edges.join(out, "src").join(into, "dst").select("src", "dst", (F.col("links") / F.col("n_out")).alias("w_out"),
                                                              (F.col("links") / F.col("n_in")).alias("w_in")), "host-edges")
    linked = e.select(F.col("src").alias("host")).unionByName(e.select(F.col("dst").alias("host"))).distinct()
    base = save(seeds.join(linked, "host", "full").select("host", F.coalesce("good", F.lit(0.0)).alias("good"),
                                                           F.coalesce("bad", F.lit(0.0)).alias("bad")), "host-seeds")
    now = base.select("host", "good", "bad", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    mass = base.agg(F.coalesce(F.sum(F.col("good") + F.col("bad")), F.lit(0.0)).alias("m")).first()["m"]
    rest = DAMPING / (1 - DAMPING)  # all later moves together, per unit of the last one
    for _ in range(2 + max(0, math.ceil(math.log(max(mass, 1.0) * rest / SETTLED) / -math.log(DAMPING)))):
        state = now.select("host", "trust", "distrust")
        flow = (e.join(state, e["src"] == state["host"]).select(F.col("dst").alias("h"), (F.col("trust") * F.col("w_out")).alias("t"), F.lit(0.0).alias("d"))
                .unionByName(e.join(state, e["dst"] == state["host"]).select(F.col("src").alias("h"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("w_in")).alias("d")))
                .groupBy("h").agg(F.sum("t").alias("t"), F.sum("d").alias("d")))
        step = now.join(flow, F.col("host") == F.col("h"), "left").select(
            "host", "good", "bad", F.col("trust").alias("t0"), F.col("distrust").alias("d0"),
            (F.col("good") + DAMPING * F.coalesce("t", F.lit(0.0))).alias("trust"), (F.col("bad") + DAMPING * F.coalesce("d", F.lit(0.0))).alias("distrust"))
        step = save(step, "host-scores")
        moved = step.agg(F.coalesce(F.sum(F.abs(F.col("trust") - F.col("t0")) + F.abs(F.col("distrust") - F.col("d0"))), F.lit(0.0)).alias("m")).first()["m"]
        now = step.drop("t0", "d0")
        if moved * rest <= SETTLED:
            break
    else:
        raise RuntimeError("scores did not settle")
    return now.select("host", "trust", "distrust")


def judge(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row."""
    judged = judged_by_rules(with_columns_of(pages, ["page_id", "url", "html"]))
    s = scores(judged).withColumnRenamed("host", "of")
    out = judged.drop("html").join(s, F.col("host") == F.col("of"), "left")
    lean = F.round(F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)), 6)
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("rule_verdict", F.when(lean > MARGIN, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")


@query("op9_url_trust")
def op9_url_trust(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
