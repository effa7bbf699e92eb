"""Section K: custom rules, sources, per-entity hook, progress."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import query
from weekloom.extension import map_entities, read_sources, with_progress
from weekloom.operators import quality as Q


@query("k1_custom_rule", """SELECT 'odd_subs' AS rule_name, false AS passed, CAST(count_if(subs % 2 = 1) AS BIGINT) AS affected_records FROM full_panel""", "full_panel")
def _(spark, sf):
    rule = Q.Rule("odd_subs", "custom", "low", "basic", lambda df, p, ctx: (df, F.when(F.col("subs") % p["of"] == 1, 1).otherwise(0), None),
                  "odd subscriber counts", {"of": 2})
    Q.register(rule)
    try:
        results = Q.validate(X.full_panel(spark, sf), "basic", X.JUNCTIONS)[1]
    finally:
        Q.REGISTRY.pop(rule.name)
    return results.filter(F.col("rule_name") == "odd_subs").select("rule_name", "passed", "affected_records")


@dataclass
class _Part:
    name: str
    sf: str

    def read(self, spark):
        rows = X.panel(spark, self.sf).filter(F.col("collection_source") == self.name)
        return rows.drop("collection_source") if self.name == "API" else rows


@query("k2_pluggable_source", "SELECT channel, week, views, collection_source FROM panel", "panel")
def _(spark, sf):
    return read_sources(spark, [_Part(n, sf) for n in ("API", "WAYBACK_CHARTS", "VIEWSTATS")]).select("channel", "week", "views", "collection_source")


def _peaks(pdf):
    pdf = pdf.sort_values("week")
    gain = pdf["views"].diff().fillna(0).astype("int64")
    at = gain.idxmax()
    return pdf.loc[[at], ["channel", "week"]].assign(gain=gain[at])


@query("k3_entity_hook", """SELECT channel, week, delta_views AS gain FROM full_panel QUALIFY row_number() OVER (PARTITION BY channel ORDER BY delta_views DESC, week) = 1""", "full_panel")
def _(spark, sf):
    return map_entities(X.panel(spark, sf).select("channel", "week", "views"), _peaks, "channel string, week date, gain bigint")


@query("k4_progress", "SELECT count(*) AS rows, max(week) AS newest FROM panel", "panel")
def _(spark, sf):
    df, seen = with_progress(X.panel(spark, sf), "panel", newest=F.max("week"))
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["rows"], seen.get["newest"])], "rows bigint, newest date")
