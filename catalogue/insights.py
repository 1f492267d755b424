"""Theme summaries, drivers, pain points and report rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.reviews import LABELLED_SQL, labelled
from revlens.operators import insights as ops

COUNTS = f"WITH {LABELLED_SQL}, counts AS (SELECT bank, sentiment_label, theme, count(*) AS n FROM themed WHERE sentiment_label IS NOT NULL GROUP BY ALL)"
RANKED = f"{COUNTS}, ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY bank, sentiment_label ORDER BY n DESC, theme) AS INT) AS rank FROM counts)"


@query(
    "theme_summary",
    f"{COUNTS} SELECT bank, sentiment_label, theme, n AS count FROM counts",
)
def theme_summary(spark, folder):
    return ops.theme_summary(labelled(spark, folder))


@query(
    "top_themes_per_bank",
    f"{RANKED} SELECT bank, sentiment_label, theme, n AS count, rank FROM ranked WHERE rank <= 3",
)
def top_themes_per_bank(spark, folder):
    return ops.top_themes(labelled(spark, folder), 3)


@query(
    "top_themes_all_sentiments",
    f"""WITH {LABELLED_SQL}, counts AS (SELECT bank, theme, count(*) AS count FROM themed GROUP BY ALL)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY bank ORDER BY count DESC, theme) AS INT) AS rank FROM counts) WHERE rank <= 5""",
)
def top_themes_all_sentiments(spark, folder):
    return ops.top_themes_by_bank(labelled(spark, folder), 5)


@query("theme_counts_per_bank", f"WITH {LABELLED_SQL} SELECT bank, theme, count(*) AS count FROM themed GROUP BY ALL")
def theme_counts_per_bank(spark, folder):
    return ops.theme_counts(labelled(spark, folder), ["bank"])


@query("theme_distribution", f"WITH {LABELLED_SQL} SELECT theme, count(*) AS count FROM themed GROUP BY ALL")
def theme_distribution(spark, folder):
    return ops.theme_counts(labelled(spark, folder)).orderBy(F.desc("count"), "theme")


@query(
    "theme_weights",
    f"{COUNTS} SELECT theme, CAST(sum(n) AS BIGINT) AS weight FROM counts WHERE sentiment_label = 'positive' GROUP BY theme",
)
def theme_weights(spark, folder):
    return ops.theme_weights(ops.theme_summary(labelled(spark, folder)), "positive")


@query(
    "theme_weights_of_bank",
    f"{COUNTS} SELECT theme, CAST(sum(n) AS BIGINT) AS weight FROM counts WHERE sentiment_label = 'negative' AND bank = 'src3' GROUP BY theme",
)
def theme_weights_of_bank(spark, folder):
    return ops.theme_weights(ops.theme_summary(labelled(spark, folder)), "negative", "src3")


@query(
    "largest_themes_of_bank",
    f"{COUNTS} SELECT bank, sentiment_label, theme, n AS count FROM counts WHERE sentiment_label = 'positive' AND bank = 'src5' ORDER BY n DESC, theme LIMIT 5",
)
def largest_themes_of_bank(spark, folder):
    return ops.largest_themes(ops.theme_summary(labelled(spark, folder)), "src5", "positive", 5)


@query(
    "theme_value_counts",
    f"WITH {LABELLED_SQL} SELECT theme, count(*) AS count FROM themed GROUP BY ALL ORDER BY count DESC, theme LIMIT 3",
)
def theme_value_counts(spark, folder):
    return ops.theme_counts(labelled(spark, folder)).orderBy(F.desc("count"), "theme").limit(3)


@query(
    "insight_lists",
    f"""{RANKED} SELECT bank,
      coalesce(string_agg(theme || '=' || n, '; ' ORDER BY rank) FILTER (WHERE sentiment_label = 'positive'), '') AS top_drivers,
      coalesce(string_agg(theme || '=' || n, '; ' ORDER BY rank) FILTER (WHERE sentiment_label = 'negative'), '') AS top_pain_points
    FROM ranked WHERE rank <= 3 GROUP BY bank""",
)
def insight_lists(spark, folder):
    tree = ops.insight_tree(labelled(spark, folder), 3)

    def text(name):
        return F.array_join(F.transform(name, lambda t: F.concat(t["theme"], F.lit("="), t["count"].cast("string"))), "; ")

    return tree.select("bank", text("top_drivers").alias("top_drivers"), text("top_pain_points").alias("top_pain_points"))


@query(
    "drivers_beside_pain_points",
    f"""{RANKED}, d AS (SELECT * FROM ranked WHERE sentiment_label = 'positive' AND rank <= 3),
      p AS (SELECT * FROM ranked WHERE sentiment_label = 'negative' AND rank <= 3)
    SELECT coalesce(d.bank, p.bank) AS bank, coalesce(d.rank, p.rank) AS rank,
      coalesce(d.theme, '') AS driver, coalesce(CAST(d.n AS VARCHAR), '') AS driver_count,
      coalesce(p.theme, '') AS pain_point, coalesce(CAST(p.n AS VARCHAR), '') AS pain_point_count
    FROM d FULL JOIN p ON d.bank = p.bank AND d.rank = p.rank""",
)
def drivers_beside_pain_points(spark, folder):
    return ops.driver_pain_table(labelled(spark, folder), 3)


@query(
    "chart_set_per_bank",
    f"""{RANKED} SELECT 'bar' AS chart, bank, sentiment_label, theme, n AS count FROM ranked WHERE rank <= 5
    UNION ALL SELECT 'cloud', bank, sentiment_label, theme, n FROM counts""",
)
def chart_set_per_bank(spark, folder):
    return ops.chart_set(labelled(spark, folder), 5)


@query(
    "report_lines_per_bank",
    f"""{RANKED}, parts AS (
      SELECT DISTINCT bank, 0 AS part, 0 AS rank, '📌 Insights for ' || bank AS line FROM cleaned WHERE bank IS NOT NULL
      UNION ALL SELECT DISTINCT bank, 1, 0, '' FROM cleaned WHERE bank IS NOT NULL
      UNION ALL SELECT DISTINCT bank, 2, 0, '✅ Top Drivers (Positive Themes):' FROM cleaned WHERE bank IS NOT NULL
      UNION ALL SELECT bank, 3, rank, '   - ' || theme || ' (' || n || ')' FROM ranked WHERE rank <= 3 AND sentiment_label = 'positive'
      UNION ALL SELECT DISTINCT bank, 4, 0, '' FROM cleaned WHERE bank IS NOT NULL
      UNION ALL SELECT DISTINCT bank, 5, 0, '❌ Top Pain Points (Negative Themes):' FROM cleaned WHERE bank IS NOT NULL
      UNION ALL SELECT bank, 6, rank, '   - ' || theme || ' (' || n || ')' FROM ranked WHERE rank <= 3 AND sentiment_label = 'negative')
    SELECT bank, CAST(row_number() OVER (PARTITION BY bank ORDER BY part, rank) - 1 AS INT) AS line_no, line FROM parts""",
)
def report_lines_per_bank(spark, folder):
    return ops.report_lines(labelled(spark, folder), 3)
