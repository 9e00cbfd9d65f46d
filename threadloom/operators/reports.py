"""Lens analyses, the scenario report, and what dashboards show of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import preview
from .backends import SCENARIO_SYSTEM, Backend, RuleBackend, generated, parsed_or_error

# Lens and role (fixed values), and what the prompt asks of it.
LENSES = [
    ("psychology", "Psychologist", "Say which feelings drive the people here and where single persons act otherwise than the group does."),
    ("economics", "Economist", "Say who gains and who pays, where money and goods move, and what could break a market."),
    ("power", "Political Strategist", "Say who decides over whom, by which means, and how much room is left to those who are decided over."),
    ("technology", "Technologist", "Say which tools and machines matter here, what they replace, and what they make possible."),
    ("history", "Historian", "Name earlier events that went alike, and what came after them."),
    ("ethics", "Ethicist", "Say whose rights are touched, which values stand against each other, and who judges whom."),
    ("statistics", "Statistician", "Say how far the data can be trusted: who is missing in them, and which figures look odd."),
]
LENS = "struct<lens:string,summary:string,key_insight:string,risk_level:string,prediction:string>"
ONE = "struct<name:string,description:string,probability:string>"
SCENARIO = f"struct<event_topic:string,past_reconstruction:string,current_state:string,scenario_a:{ONE},scenario_b:{ONE},scenario_c:{ONE},early_warning_signals:array<string>>"


def lenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *x) for i, x in enumerate(LENSES)], "place int, lens string, role string, focus string")


def lens_prompts(summary: DataFrame) -> DataFrame:
    """place, lens, system, user: the one-row summary before each of the seven lenses."""
    text = summary.select(F.col("summary"))
    asked = F.lit('Answer as JSON with the keys "lens", "summary" (two sentences), "key_insight", "risk_level" (Low / Medium / High) and "prediction".')
    rows = lenses(summary.sparkSession).join(F.broadcast(text))  # seven rows and one
    return rows.select("place", "lens", F.format_string("You are an expert %s. %s", "role", "focus").alias("system"), F.concat_ws("\n\n", asked, "summary").alias("user"))


def lens_reports(summary: DataFrame, backend: Backend | None = None) -> DataFrame:
    """place, lens, summary, key_insight, risk_level, prediction, raw_analysis, error of the seven lenses."""
    answered = generated(lens_prompts(summary), F.col("system"), F.col("user"), backend or RuleBackend())
    out = answered.select("place", "lens", parsed_or_error(F.col("answer"), LENS).alias("p"))
    return out.select("place", "lens", "p.value.summary", "p.value.key_insight", "p.value.risk_level", "p.value.prediction", "p.raw_analysis", "p.error")


def scenario_context(reports: DataFrame) -> DataFrame:
    """One row, `context`: a section for each lens that did not fail, in lens order."""
    value = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    section = F.concat_ws(
        "\n",
        F.concat(F.lit("--- "), F.upper("lens"), F.lit(" LENS ---")),
        F.concat(F.lit("Risk Level: "), value("risk_level", "Unknown")),
        F.concat(F.lit("Summary: "), value("summary", "N/A")),
        F.concat(F.lit("Key Insight: "), value("key_insight", "N/A")),
    )
    good = reports.where("error IS NULL").agg(F.array_sort(F.collect_list(F.struct("place", section.alias("section")))).alias("s"))
    return good.select(F.array_join(F.transform("s", lambda x: x["section"]), "\n").alias("context"))


def scenario(context: DataFrame, backend: Backend | None = None) -> DataFrame:
    """One row: the report by SCENARIO, or error and raw_content."""
    backend = backend or RuleBackend()
    system = F.lit(SCENARIO_SYSTEM)
    asked = F.lit('From the analyses below answer as JSON with the keys "event_topic", "past_reconstruction", "current_state", "scenario_a", "scenario_b" and "scenario_c" (each with "name", "description", "probability"), "early_warning_signals" (three).')
    answered = generated(context, system, F.concat_ws("\n\n", asked, "context"), backend)
    out = answered.select(parsed_or_error(F.col("answer"), SCENARIO).alias("p"))
    return out.select("p.value.*", "p.error", F.col("p.raw_analysis").alias("raw_content"))


def report_view(report: DataFrame) -> DataFrame:
    """The report with what stands for missing values."""
    value = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    cards = [value(f"scenario_{k}.{f}", d).alias(f"{k}_{f}") for k in "abc" for f, d in (("name", "N/A"), ("probability", "N/A"), ("description", "No description available"))]
    return report.select(value("event_topic", "Unknown Event").alias("topic"), value("past_reconstruction", "N/A").alias("past"), value("current_state", "N/A").alias("now"), *cards)


def report_signals(report: DataFrame) -> DataFrame:
    return report.select(F.posexplode("early_warning_signals").alias("i", "signal")).select((F.col("i") + 1).alias("number"), "signal")


def sidebar(document: DataFrame) -> DataFrame:
    """title, summary, negative, positive, drivers of a document (scenario_analysis, metadata)."""
    s = "scenario_analysis"
    return document.select(
        F.coalesce(F.nullif(F.col(f"{s}.title"), F.lit("")), F.lit("General Overview")).alias("title"), F.coalesce(F.nullif(F.col(f"{s}.summary"), F.lit("")), F.lit("No summary available.")).alias("summary"),
        F.col("metadata.overall_average_sentiment.negative").alias("negative"), F.col("metadata.overall_average_sentiment.positive").alias("positive"), F.coalesce(f"{s}.key_drivers", F.array().cast("array<string>")).alias("drivers"),
    )


def report_previews(reports: DataFrame, n: int = 300) -> DataFrame:
    return reports.select("lens", preview(F.coalesce("summary", F.lit("N/A")), n).alias("preview"))
