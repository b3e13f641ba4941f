"""The state of a fleet of workers as DataFrame updates: finished files, stuck jobs, retries, new batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import done_line
from .relational import next_batch


def done_events(logs: DataFrame, line: str = "line") -> DataFrame:
    """(job_id, input_file, rows, elapsed_s) of log lines that name a finished file; of repeated ones the last by time counts."""
    one = logs.withColumn("__d", done_line(F.col(line))).filter(F.col("__d").isNotNull()).select("job_id", "ts", "__d.*")
    return one.groupBy("job_id", F.col("file").alias("input_file")).agg(F.max_by("rows", "ts").alias("rows"), F.max_by("elapsed_s", "ts").alias("elapsed_s"))


def apply_done(manifest: DataFrame, events: DataFrame) -> DataFrame:
    """Rows assigned to the very job that reports them become done, with its rows and seconds and an output below the file's year."""
    e = events.select(F.col("input_file").alias("e_file"), F.col("job_id").alias("e_job"), F.col("rows").alias("e_rows"), F.col("elapsed_s").alias("e_s"))
    joined = manifest.join(e, (F.col("input_file") == F.col("e_file")) & (F.col("job_id") == F.col("e_job")), "left")
    hit = F.col("e_file").isNotNull() & (F.col("status") == "assigned")
    parts = F.split("input_file", "/")
    out = F.concat(F.lit("predictions/"), F.element_at(parts, -2), F.lit("/"), F.element_at(parts, -1))
    new = {"status": F.lit("done"), "rows": F.col("e_rows"), "elapsed_s": F.col("e_s"), "output_path": out}
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in manifest.columns])


def stuck(jobs: DataFrame, now: Column, minutes: float) -> DataFrame:
    """``jobs`` (job_id, stage, last_log, submitted) with ``reason``: running and silent, or waiting to be scheduled, for over ``minutes``."""
    age = lambda c: (now.cast("double") - F.col(c).cast("double")) / 60
    reason = F.when((F.col("stage") == "RUNNING") & (age("last_log") > minutes), "silent-stuck").when((F.col("stage") == "SCHEDULING") & (age("submitted") > minutes), "sched-stuck")
    return jobs.withColumn("reason", reason)


def release(manifest: DataFrame, jobs: DataFrame, most_attempts: int = 3) -> DataFrame:
    """Assigned rows of jobs that ended or are stuck go back to pending, or fail at ``most_attempts``; being stuck costs no attempt.

    ``jobs`` has one row a job.
    """
    j = jobs.select(F.col("job_id").alias("j_id"), F.col("stage").alias("j_stage"), F.col("reason").alias("j_reason"))
    joined = manifest.join(j, F.col("job_id") == F.col("j_id"), "left")
    infra = F.col("j_reason").isNotNull()
    hit = F.coalesce((F.col("status") == "assigned") & (infra | F.col("j_stage").isin("COMPLETED", "ERROR", "CANCELED")), F.lit(False))
    attempts = F.coalesce("attempts", F.lit(0)) + F.when(infra, 0).otherwise(1)
    failed = ~infra & (attempts >= most_attempts)
    new = {
        "status": F.when(failed, "failed").otherwise("pending"), "attempts": attempts, "job_id": F.when(failed, F.col("job_id")),
        "error": F.when(infra, F.concat(F.lit("job "), F.col("job_id"), F.lit(" cancelled (infra: "), F.col("j_reason"), F.lit(")"))).otherwise(F.concat(F.lit("job "), F.col("job_id"), F.lit(" stage="), F.col("j_stage"))),
    }
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in manifest.columns])


def reestimate(manifest: DataFrame, seconds_per_byte: float) -> DataFrame:
    """Estimates of pending rows by the present average."""
    return manifest.withColumn("est_seconds", F.when(F.col("status") == "pending", F.col("size_bytes") * seconds_per_byte).otherwise(F.col("est_seconds")))


def assign(manifest: DataFrame, job_id: str, target_seconds: float = 5400.0, most: int = 50) -> DataFrame:
    """The next batch of pending rows, longest first, becomes the job's."""
    batch = next_batch(manifest.filter("status = 'pending'").withColumn("__one", F.lit(1)), "__one", "est_seconds", "input_file", target_seconds, most).select(F.col("input_file").alias("b_file"))
    joined = manifest.join(F.broadcast(batch), F.col("input_file") == F.col("b_file"), "left")  # ``most`` rows
    hit = F.col("b_file").isNotNull() & (F.col("status") == "pending")
    new = {"status": F.lit("assigned"), "job_id": F.lit(job_id)}
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in manifest.columns])


def run_fleet(manifest: DataFrame, submit: Callable[[list[str]], str], poll: Callable[[str], tuple[str, list[tuple[str, int, float]]]], save: Callable[[DataFrame], DataFrame], most_in_flight: int = 8, most_attempts: int = 3, rounds: int = 1000) -> DataFrame:
    """The loop over submit and poll functions until nothing is pending or assigned: each state is a table that ``save`` writes and reads back.

    ``submit`` takes a batch's files and gives a job's name; ``poll`` gives (stage, finished files with rows and seconds).
    """
    spark = manifest.sparkSession
    jobs: set[str] = set()
    for _ in range(rounds):
        seen = {j: poll(j) for j in jobs}
        events = [(j, f, n, s) for j, (_, done) in seen.items() for f, n, s in done]
        if events:
            manifest = apply_done(manifest, spark.createDataFrame(events, "job_id string, input_file string, rows bigint, elapsed_s double"))
        ended = [(j, stage, None) for j, (stage, _) in seen.items() if stage in ("COMPLETED", "ERROR", "CANCELED")]
        if ended:
            manifest = release(manifest, spark.createDataFrame(ended, "job_id string, stage string, reason string"), most_attempts)
            jobs -= {j for j, _, _ in ended}
        manifest = save(manifest)
        while len(jobs) < most_in_flight:
            name = f"pending-{len(jobs)}"
            trial = save(assign(manifest, name))
            files = [r["input_file"] for r in trial.filter(F.col("job_id") == name).select("input_file").collect()]  # one batch
            if not files:
                break
            job = submit(sorted(files))
            manifest = save(trial.withColumn("job_id", F.when(F.col("job_id") == name, job).otherwise(F.col("job_id"))))
            jobs.add(job)
        if not jobs and not manifest.filter("status in ('pending', 'assigned')").limit(1).count():
            break
    return manifest


def valid_number_columns(words: DataFrame, keys: list[str], order: str, value: str, least: int = 4, most_step: float = 1.5, density: float = 0.7) -> DataFrame:
    """Keys (of page columns) whose numbers grow strictly, by ``most_step`` on average, and fill ``density`` of their range."""
    w = Window.partitionBy(*keys).orderBy(order)
    steps = words.withColumns({"__d": F.col(value) - F.lag(value).over(w), "__first": F.first(value).over(w)})
    g = steps.groupBy(*keys).agg(F.count("*").alias("n"), F.min("__d").alias("low"), F.avg("__d").alias("mean"), (F.max_by(value, order) - F.min_by(value, order) + 1).alias("range"))
    return g.filter((F.col("n") >= least) & (F.col("low") > 0) & (F.col("mean") <= most_step) & (F.col("range") > 0) & (F.col("n") / F.col("range") >= density)).select(*keys)


def repeating_headers(headers: DataFrame, pages: DataFrame, least: int = 2) -> DataFrame:
    """(file, text, pages) of header texts on ``least`` pages and a tenth of the file's pages at least; ``pages``: (file, page_count)."""
    seen = headers.groupBy("file", "text").agg(F.countDistinct("page").alias("pages"))
    return seen.join(pages, "file").filter(F.col("pages") >= F.greatest(F.lit(least), F.floor(F.col("page_count") * 0.1))).select("file", "text", "pages")


def clustered_headers(headers: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(file, page, text, group): each text, in the order of pages, joins the best group of ``threshold`` or begins its own; a group is named by its first text."""
    from difflib import SequenceMatcher

    import pandas as pd

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        groups: list[str] = []
        out = []
        for page, text in pdf.sort_values(["page", "text"])[["page", "text"]].itertuples(index=False):
            best = max(((SequenceMatcher(None, text, g).ratio(), -k) for k, g in enumerate(groups)), default=(0.0, 0))
            if best[0] < threshold:
                groups.append(text)
                best = (1.0, -(len(groups) - 1))
            out.append((pdf["file"].iloc[0], page, text, groups[-best[1]]))
        return pd.DataFrame(out, columns=["file", "page", "text", "group"])

    kept = headers.filter(F.coalesce(F.col("text"), F.lit("")) != "").select("file", F.col("page").cast("int").alias("page"), "text")
    return kept.groupBy("file").applyInPandas(cluster, "file string, page int, text string, group string")
