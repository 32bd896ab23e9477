"""Large files in parallel, time, streams with state, sketches, ranges, subtotals, custom checks, sequence checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.operators import bands, checks, compare, ingest, labels, profile
from pairloom.session import new_folder, stage
from pairloom.sources import readers
from pairloom.streaming import append, state
from workload import inputs as I
from workload.registry import query, r6
from workload.sqltext import DIRTY, DOCS, LABEL_LOG, RUN_A, issues_of, pair_id as sql_pair_id, pairs_of, strip

_LINES = f"""WITH {DOCS} SELECT topic AS category, count(*) AS n, CAST(sum(length({strip('completion')})) AS BIGINT) AS chars,
  count(DISTINCT {strip('prompt')}) AS prompts FROM docs GROUP BY topic"""


def _by_category(rows: DataFrame) -> DataFrame:
    return ingest.normalize_rows(rows).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("output")).alias("chars"), F.count_distinct("instruction").alias("prompts"))


@query("A3", _LINES)
def csv_line_breaks(spark, sf):
    """Whole documents, line breaks and all, as cells of CSV files that many tasks cut."""
    path = new_folder(spark, "csv") + ".csv"
    I.raw_docs(spark, sf).select("prompt", "completion", "topic").write.option("header", True).option("escape", '"').option("quoteAll", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return _by_category(readers.read_rows(spark, path))


@query("A2", _LINES)
def large_json_documents(spark, sf):
    """Documents as JSON lists that many tasks cut into their elements."""
    path = new_folder(spark, "json")
    item = F.to_json(F.struct("prompt", "completion", "topic"))
    lists = I.json_lists(I.raw_docs(spark, sf).select(item.alias("item")), '{"source": ["}", {"data": [0]}], "data": [')
    lists.write.text(path)
    return _by_category(readers.read_json(spark, path, whole_bytes=1000).select("seq", "row"))


_AS_OF = """WITH v AS (SELECT event_id, ts, user_id, value >= 5 AS pred FROM events WHERE event_type = 'view'),
l AS (SELECT ts, user_id, event_type FROM events WHERE event_type <> 'view')"""


def _verdict_times(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Views as verdicts about their user, all other events as labels, with their times."""
    events = I.table(spark, sf, "events")
    verdicts = events.filter("event_type = 'view'").select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("pair_id"), (F.col("value") >= 5).alias("passed"),
        F.col("ts").alias("judged_at"))
    log = I.label_log(spark, sf).withColumn("labeled_at", F.col("seq.ts")).filter("tag <> 'view'")
    return verdicts, log


@query("G8", f"""{_AS_OF}, j AS (SELECT v.*, l.event_type = 'purchase' AS truth FROM v ASOF JOIN l ON v.user_id = l.user_id AND v.ts >= l.ts),
c AS (SELECT count(*) AS n_evaluated, count(*) FILTER (pred AND truth) AS tp, count(*) FILTER (pred AND NOT truth) AS fp,
  count(*) FILTER (NOT pred AND NOT truth) AS tn, count(*) FILTER (NOT pred AND truth) AS fn FROM j)
SELECT *, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy FROM c""")
def calibration_as_of(spark, sf):
    """Verdicts against the last label before them."""
    found = compare.calibrate_as_of(*_verdict_times(spark, sf))
    return found.select("n_evaluated", "tp", "fp", "tn", "fn", r6("precision"), r6("recall"), r6("accuracy"))


@query("F4 G8", f"{_AS_OF} SELECT v.event_id AS seq, l.event_type AS tag, l.ts AS labeled_at FROM v ASOF LEFT JOIN l ON v.user_id = l.user_id AND v.ts >= l.ts")
def labels_as_of(spark, sf):
    """What was known of a pair at each verdict."""
    verdicts, log = _verdict_times(spark, sf)
    named = log.withColumn("labeler", F.col("tag"))
    return compare.labels_as_of(verdicts, named).select("seq", F.col("known.labeler").alias("tag"), F.col("known.labeled_at").alias("labeled_at"))


@query("F4 A10", f"WITH {LABEL_LOG} SELECT pair_id, status, tag FROM llast")
def streamed_labels(spark, sf):
    """Events as label files that arrive in several batches, some lines twice; the stored state after the last one."""
    folder, path, checkpoint = (new_folder(spark, n) for n in ("label-files", "label-state", "label-checkpoint"))
    log = I.label_log(spark, sf).select(
        "pair_id", "status", "tag", "note", "labeler",
        F.date_format("seq.ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("labeled_at"))
    lines = log.select(F.to_json(F.struct("*")).alias("value"))
    again = log.filter("status = 'approved'").select(F.to_json(F.struct("*")).alias("value"))
    lines.unionByName(again).repartition(6).write.text(folder)
    state.follow_labels(state.label_lines(spark, folder, per_trigger=2), path, checkpoint, late="400 days").awaitTermination()
    return state.followed_labels(spark, path).select("pair_id", "status", "tag")


@query("B7 C3", f"""WITH {DIRTY}, p AS (SELECT {strip('prompt')} AS i, {strip('completion')} AS o FROM dirty)
SELECT {sql_pair_id('i', 'o')} AS id, i AS instruction, length(o) AS chars FROM p WHERE i <> '' OR o <> '' GROUP BY i, o""")
def streamed_pairs(spark, sf):
    """Raw files that arrive in several batches, each pair stored once."""
    folder, path, checkpoint = (new_folder(spark, n) for n in ("pair-files", "pair-table", "pair-checkpoint"))
    rows = I.raw_dirty(spark, sf)
    both = rows.unionByName(rows.filter("seq % 3 = 0")).select(F.to_json(F.struct("prompt", "completion", "topic")).alias("value"))
    both.write.text(folder)   # a file from each task, so that no task holds a fixed share of all rows
    third = -(-both.rdd.getNumPartitions() // 3)
    pairs = lambda raw: ingest.drop_empty(ingest.normalize_rows(raw, order="arrived"))
    state.follow_pairs(pairs(append.appended_lines(spark, folder, per_trigger=third)), path, checkpoint).awaitTermination()
    return spark.read.parquet(path).select("id", "instruction", F.length("output").cast("long").alias("chars"))


@query("F4 F7", """WITH e AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR ts - before > INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM e),
s AS (SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS approved,
  count(*) FILTER (event_type = 'error') AS rejected FROM i GROUP BY user_id, island)
SELECT CAST(user_id AS VARCHAR) AS labeler, epoch_us(started) AS started, n, approved, rejected, date_diff('microsecond', started, ended) AS micros,
  date_diff('microsecond', lag(ended) OVER (PARTITION BY user_id ORDER BY started), started) AS pause_micros FROM s""")
def label_sessions(spark, sf):
    """Stretches of work of every labeler; here the users of the events, with breaks of six hours."""
    log = I.label_log(spark, sf).withColumns({"labeled_at": F.col("seq.ts").cast("timestamp"), "labeler": F.col("pair_id")})
    found = labels.label_sessions(log, "6 hours")
    return found.select("labeler", F.unix_micros("started").alias("started"), "n", "approved", "rejected",
                        F.round(F.col("minutes") * 6e7).cast("long").alias("micros"), F.round(F.col("pause_minutes") * 6e7).cast("long").alias("pause_micros"))


SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("J5 H2 H6", f"""WITH {RUN_A}, d AS (SELECT ja.*, doc.lang, doc.source FROM ja JOIN documents doc ON doc.doc_id = ja.seq)
SELECT lang, share, count(*) AS n, true AS close, true AS distinct_close FROM d, (SELECT unnest({SHARES}) AS share) GROUP BY lang, share""")
def merged_sketches(spark, sf):
    """Quantiles of scores per language from sketches stored per language and source; each within its error of the exact ranks."""
    docs = I.table(spark, sf, "documents").select(F.col("doc_id").alias("seq"), "lang", "source")
    rows = I.judge_a(spark, sf).join(docs, "seq").select("lang", "source", "pair_id", F.col("scores.overall").alias("overall"))
    stored = stage(profile.sketches(rows, ["lang", "source"], "overall", "pair_id"), "sketches")
    found = profile.read_sketches(profile.merge_sketches(stored, ["lang"]), SHARES)
    exact = rows.withColumnRenamed("lang", "l").join(F.broadcast(found), F.col("l").eqNullSafe(F.col("lang"))).groupBy("lang", "share", "n", "distinct").agg(
        (F.count_if(F.col("overall") < F.col("value")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("overall") <= F.col("value")) / F.count(F.lit(1))).alias("upto"))
    slack = 0.015 + 1 / F.col("n")
    return exact.select("lang", "share", "n", ((F.col("below") - slack <= F.col("share")) & (F.col("share") <= F.col("upto") + slack)).alias("close"),
                        (F.abs(F.col("distinct") - F.col("n")) <= 0.06 * F.col("n") + 1).alias("distinct_close"))


@query("E12 G4 J2", f"""WITH {RUN_A}, b AS (SELECT user_id, min(value) AS low, CASE WHEN user_id % 7 = 0 THEN NULL ELSE max(value) END AS high
  FROM events WHERE event_type = 'click' GROUP BY user_id)
SELECT ja.pair_id, count(*) AS n, min(user_id) AS least, CAST(sum(user_id) AS BIGINT) AS total FROM ja JOIN b
  ON ja.overall * 10 >= b.low AND (b.high IS NULL OR ja.overall * 10 < b.high) GROUP BY ja.pair_id""")
def score_bands(spark, sf):
    """Scores joined with ranges given as a table: the values that each user clicked between."""
    clicks = I.table(spark, sf, "events").filter("event_type = 'click'").groupBy("user_id").agg(
        F.min("value").alias("low"), F.max("value").alias("high"))
    ranges = clicks.withColumn("high", F.when(F.col("user_id") % 7 != 0, F.col("high")))
    scores = I.judge_a(spark, sf).select("pair_id", (F.col("scores.overall") * 10).alias("points"))
    found = bands.band_totals(scores, "points", ranges, [
        F.count(F.lit(1)).alias("n"), F.min("user_id").alias("least"), F.sum("user_id").alias("total")])
    return found.groupBy("pair_id").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("total").alias("total"))


@query("C8 H3", f"""WITH {DIRTY}, {pairs_of('dirty')}, {issues_of('pairs')}, x AS (
  SELECT i."check", i.severity, p.category, p.difficulty FROM issues i JOIN pairs p USING (seq) WHERE i."check" <> 'dedup')
SELECT "check", severity, category, difficulty, CAST(grouping("check", severity, category, difficulty) AS BIGINT) AS level, count(*) AS n
FROM x GROUP BY CUBE ("check", severity, category, difficulty)""")
def issue_cube(spark, sf):
    """All subtotals of the issues by check, severity, source and language."""
    facts = checks.check_facts(I.dirty_pairs(spark, sf), checks.DEFAULT_CHECKS, keep=("category", "difficulty"))
    return checks.issue_cube(facts, "category", "difficulty").withColumn("level", F.col("level").cast("long"))


def _repeated_lines(instruction, output):
    """A check of a user's own: every line that follows itself, and an error for some texts."""
    lines = (output or "").split("\n")
    for n, (a, b) in enumerate(zip(lines, lines[1:])):
        if a and a == b:
            yield "warning", f"line {n + 1} again", "output"
    if len(lines) > 40:
        raise ValueError("too many lines")


@query("C7 C9", f"""WITH {DOCS}, {pairs_of('docs')}, x AS (SELECT seq, id, string_split(output, chr(10)) AS ls FROM pairs),
u AS (SELECT seq, id, unnest(range(1, len(ls))) AS i, ls FROM x), g AS (
SELECT seq, id AS pair_id, 'lines' AS "check", 'warning' AS severity, 'line ' || i || ' again' AS message, 'output' AS field FROM u WHERE ls[i] = ls[i + 1] AND ls[i] <> ''
UNION ALL SELECT seq, id, 'lines', 'error', 'lines failed: ValueError: too many lines', NULL FROM x WHERE len(ls) > 40
UNION ALL SELECT seq, id, 'length', 'warning', 'output longer than 8000 chars', 'output' FROM pairs WHERE length(output) > 8000
UNION ALL SELECT seq, id, 'length', 'warning', 'instruction shorter than 3 chars', 'instruction' FROM pairs WHERE length(instruction) < 3)
SELECT *, seq IN (SELECT seq FROM g WHERE severity = 'error') AS gone FROM g""")
def custom_check(spark, sf):
    """A check written in Python among the others: in the issue table and in what the clean set loses."""
    pairs = I.doc_pairs(spark, sf)
    facts = stage(checks.check_facts(pairs, ["length"], custom={"lines": _repeated_lines}), "facts")
    kept = checks.clean_order(facts, drop_copies=False).withColumn("kept", F.lit(True))
    return checks.issues(facts).join(kept, "seq", "left").select(
        "seq", "pair_id", "check", "severity", "message", "field", F.col("kept").isNull().alias("gone"))


@query("B8", f"""WITH {DOCS}, h AS (SELECT seq, CAST('0x' || substr(sha256(prompt || chr(31) || completion), 1, 15) AS HUGEINT) AS d FROM docs)
SELECT count(*) AS row_count, CAST(list_reduce(list(d ORDER BY seq), lambda a, b: (a * 1000003 + b) % 2305843009213693951) AS BIGINT) AS checksum FROM h""")
def sequence_checksum(spark, sf):
    """A checksum of the documents in their order."""
    return ingest.sequence_fingerprint(I.doc_pairs(spark, sf)).select("row_count", "checksum")
