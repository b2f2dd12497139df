"""Alerts over a stream of cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .. import rules
from ..functions.association import chi2_p_value
from ..functions.text import strip
from ..operators.boost import BoostedTrees
from ..operators.clean import severity_label
from ..plans.training import CaseEncoder, FittedModel


def first_pair(cases: DataFrame) -> DataFrame:
    """The first drug and first reaction of a case; cases lacking either are skipped."""
    return cases.filter((F.size("drugs") > 0) & (F.size("reactions") > 0)).withColumns(
        {"drugname": F.get("drugs", F.lit(0)), "pt": F.get("reactions", F.lit(0))}
    )


def alert_text(level, sure):
    """The fixed sentence with its three values."""
    out = F.lit(rules.ALERT_TEXT)
    for name, value in (("level", level.cast("string")), ("label", severity_label(level)), ("share", F.format_string("%.2f%%", sure * 100))):
        out = F.replace(out, F.lit(f"{{{name}}}"), value)
    return out


def severity_alerts(
    cases: DataFrame, encoder: CaseEncoder, model: FittedModel, least: int = rules.ALERT_MIN_SEVERITY
) -> DataFrame:
    """Cases predicted severe. Stateless, so it runs on a stream or a table alike."""
    scored = model.predict(encoder.transform(first_pair(cases)))
    level, sure = F.col("prediction"), F.col("confidence")
    reason = alert_text(level, sure)
    return scored.filter(level >= least).select(
        F.current_timestamp().alias("alert_timestamp"),
        "primaryid",
        "sex",
        "age",
        "drugname",
        "pt",
        level.alias("predicted_severity"),
        severity_label(level).alias("severity_label"),
        F.round(sure, 4).alias("confidence_score"),
        F.lit(rules.ALERT_TYPE).alias("alert_type"),
        reason.alias("alert_reason"),
        "outcomes",
    )


def table_alerts(cases: DataFrame, model: BoostedTrees, ident: str = "primaryid", least: int = rules.ALERT_MIN_SEVERITY) -> DataFrame:
    """Cases that a table of nodes scores at ``least`` or above: the key, the level, its label and the share of its class."""
    scored = model.predict(cases).filter(F.col("prediction") >= least)
    return scored.select(
        ident,
        F.col("prediction").alias("predicted_severity"),
        severity_label("prediction").alias("severity_label"),
        F.round("confidence", 6).alias("confidence_score"),
    )


def exploded_pairs(cases: DataFrame, *keep: str) -> DataFrame:
    """Distinct drug and reaction pairs of every case, names normalised."""
    one = cases.select(*keep, F.explode(F.array_distinct("drugs")).alias("drugname"), "reactions").select(
        *keep, "drugname", F.explode(F.array_distinct("reactions")).alias("pt")
    )
    return one.withColumns({"drugname": F.upper(strip("drugname")), "pt": F.upper(strip("pt"))})


def _confirmed(counts: DataFrame, signals: DataFrame, min_cases: int, prr: float, p_value: float) -> DataFrame:
    known = signals.select("drugname", "pt", "prr", "chi2").withColumn("p_value", chi2_p_value(F.col("chi2")))
    known = known.filter((F.col("prr") > prr) & (F.col("p_value") < p_value))
    return counts.filter(F.col("n_cases_in_batch") >= min_cases).join(known, ["drugname", "pt"])


def signal_alerts(
    batch: DataFrame,
    signals: DataFrame,
    min_cases: int = rules.ALERT_MIN_CASES,
    prr: float = rules.ALERT_PRR,
    p_value: float = rules.ALERT_P_VALUE,
) -> DataFrame:
    """At most one alert per pair of a batch: enough cases, and a known strong signal.

    A case counts once per pair, however often it repeats the pair.
    """
    counts = (
        exploded_pairs(batch, "primaryid")
        .distinct()
        .groupBy("drugname", "pt")
        .agg(F.count(F.lit(1)).alias("n_cases_in_batch"))
    )
    return _confirmed(counts, signals, min_cases, prr, p_value).select(
        "drugname", "pt", "prr", "p_value", "n_cases_in_batch"
    )


def windowed_signal_alerts(
    stream: DataFrame,
    signals: DataFrame,
    every: str = "1 hour",
    late: str = "10 minutes",
    min_cases: int = rules.ALERT_MIN_CASES,
    prr: float = rules.ALERT_PRR,
    p_value: float = rules.ALERT_P_VALUE,
) -> DataFrame:
    """Signal alerts per event-time window, independent of how batches were cut.

    Append mode: a window is reported once, when the watermark has passed it, and
    its state is dropped then.
    """
    pairs = exploded_pairs(stream.withWatermark("ts", late), "primaryid", "ts")
    spans = pairs.select("primaryid", "drugname", "pt", F.window("ts", every).alias("window"))
    once = spans.dropDuplicates(["primaryid", "drugname", "pt", "window"])
    counts = once.groupBy("window", "drugname", "pt").agg(F.count(F.lit(1)).alias("n_cases_in_batch"))
    return _confirmed(counts, signals, min_cases, prr, p_value).select(
        F.col("window.start").alias("window_start"), "drugname", "pt", "prr", "p_value", "n_cases_in_batch"
    )


def level_counts(alerts: DataFrame, level: str = "predicted_severity") -> DataFrame:
    """Running number of alerts per level: a streaming aggregate over all batches."""
    return alerts.groupBy(level).agg(F.count(F.lit(1)).alias("alerts"))


def running_counters(cases: DataFrame, alert_flag: str, level: str) -> DataFrame:
    """Consumed cases and alerts per level so far."""
    return cases.groupBy(level).agg(
        F.count(F.lit(1)).alias("consumed"), F.sum(F.when(F.col(alert_flag), 1).otherwise(0)).alias("alerts")
    )


def write_per_batch(stream: DataFrame, path: str, checkpoint: str, make=None, mode: str = "append") -> DataStreamWriter:
    """Write each micro-batch under its own number.

    A batch that is replayed after a failure overwrites its own folder, so restarts
    neither lose nor repeat alerts.
    """

    def save(batch: DataFrame, number: int) -> None:
        out = make(batch) if make else batch
        out.write.mode("overwrite").json(f"{path}/batch={number}")

    return (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    )


#: What is there now, and then the query ends. A service passes {"processingTime": "10 seconds"} and stays on its topic.
ONCE = {"availableNow": True}


def start_signal_alerts(
    stream: DataFrame, signals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **limits
) -> StreamingQuery:
    """Signal alerts with the micro-batch as the scope of counting; ``trigger`` as in ``DataStreamWriter.trigger``."""
    writer = write_per_batch(stream, path, checkpoint, lambda b: signal_alerts(b, signals, **limits))
    return writer.trigger(**(trigger or ONCE)).start()


def start_level_counts(
    alerts: DataFrame, path: str, checkpoint: str, level: str = "predicted_severity", trigger: dict | None = None
) -> StreamingQuery:
    """Running alert totals by level; each batch writes the totals so far under its own number."""
    writer = write_per_batch(level_counts(alerts, level), path, checkpoint, mode="complete")
    return writer.trigger(**(trigger or ONCE)).start()


def start_table_alerts(
    stream: DataFrame, model: BoostedTrees, path: str, checkpoint: str, ident: str = "primaryid",
    least: int = rules.ALERT_MIN_SEVERITY, trigger: dict | None = None,
) -> StreamingQuery:
    """Severity alerts of each batch, scored from a table of nodes; a replayed batch overwrites its own alerts."""
    writer = write_per_batch(stream, path, checkpoint, lambda b: table_alerts(b, model, ident, least))
    return writer.trigger(**(trigger or ONCE)).start()


def start_severity_alerts(
    stream: DataFrame, encoder: CaseEncoder, model: FittedModel, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Severity alerts appended as JSON lines by the file sink (exactly once)."""
    return (
        severity_alerts(stream, encoder, model)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ONCE))
        .start()
    )
