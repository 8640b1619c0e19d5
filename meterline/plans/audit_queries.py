"""Month keys, landing paths, probe and month outcomes, run audit, run events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions import months, outcomes, paths
from meterline.operators import runs
from meterline.plans.given import RUNS_SQL, customer_runs, table
from meterline.plans.registry import plain, query
from meterline.streaming import events as log


def _pick(key: Column, *values: Column | str) -> Column:
    """``values[key % len(values)]`` as a CASE."""
    choice = None
    for i, value in enumerate(values[:-1]):
        value = F.lit(value) if isinstance(value, str) else value
        hit = key % len(values) == i
        choice = F.when(hit, value) if choice is None else choice.when(hit, value)
    last = values[-1]
    return choice.otherwise(F.lit(last) if isinstance(last, str) else last)


@query(
    "month_window",
    f"""
    WITH {RUNS_SQL},
    covered AS (
      SELECT unnest(generate_series(CAST(start_year_month || '-01' AS DATE),
                                    CAST(end_year_month || '-01' AS DATE),
                                    INTERVAL 1 MONTH)) AS m FROM runs)
    SELECT strftime(m, '%Y-%m') AS year_month, count(*) AS windows FROM covered GROUP BY 1
    """,
)
def month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many run windows cover each month."""
    windows = customer_runs(spark, sf_dir).select(
        F.explode(months.expand_window("start_year_month", "end_year_month")).alias("year_month")
    )
    return windows.groupBy("year_month").agg(F.count(F.lit(1)).alias("windows"))


@query(
    "month_parse",
    r"""
    WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym FROM orders),
    v AS (SELECT o_orderkey, CASE o_orderkey % 7
        WHEN 0 THEN ym WHEN 1 THEN replace(ym, '-0', '-') WHEN 2 THEN replace(ym, '-', '/')
        WHEN 3 THEN ' ' || ym WHEN 4 THEN substr(ym, 1, 5) || '13' WHEN 5 THEN ym || '-15'
        END AS raw FROM t)
    SELECT o_orderkey, coalesce(ok, FALSE) AS valid,
           CASE WHEN ok THEN CAST(substr(raw, 1, 4) AS INT) END AS year,
           CASE WHEN ok THEN CAST(substr(raw, 6, 2) AS INT) END AS month
    FROM (SELECT *, regexp_full_match(raw, '\d{4}-(0[1-9]|1[0-2])') AS ok FROM v)
    """,
)
def month_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed and malformed month texts of all orders."""
    ym = months.year_month("o_orderdate")
    raw = _pick(
        F.col("o_orderkey"),
        ym,
        F.regexp_replace(ym, "-0", "-"),
        F.regexp_replace(ym, "-", "/"),
        F.concat(F.lit(" "), ym),
        F.concat(F.substring(ym, 1, 5), F.lit("13")),
        F.concat(ym, F.lit("-15")),
        F.lit(None).cast("string"),
    )
    parsed = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return parsed.select(
        "o_orderkey",
        months.is_year_month("raw").alias("valid"),
        months.parse_year_month("raw", strict=False).alias("p"),
    ).select("o_orderkey", "valid", "p.year", "p.month")


BASES = (
    "/Volumes/main/bronze/landing/yellow",
    "/Volumes/main/bronze/landing//",
    "/Volumes/c/s/v",
    "/Volumes/only/two/",
    "/dbfs/main/bronze/landing",
    "   ",
)
BASES_SQL = " ".join(f"WHEN {i} THEN '{b}'" for i, b in enumerate(BASES))


@query(
    "landing_paths",
    rf"""
    WITH t AS (
      SELECT o_orderkey, CASE o_custkey % 6 {BASES_SQL} END AS base,
             CASE WHEN o_orderkey % 5 = 0 THEN replace(strftime(o_orderdate, '%Y-%m'), '-0', '-')
                  ELSE strftime(o_orderdate, '%Y-%m') END AS ym
      FROM orders),
    p AS (
      SELECT *, regexp_full_match(ym, '\d{{4}}-(0[1-9]|1[0-2])') AS month_ok,
             list_filter(string_split(substr(base, 10), '/'), lambda s: s <> '') AS seg FROM t)
    SELECT o_orderkey,
           CASE WHEN month_ok THEN '{paths.SOURCE_BASE}/yellow_tripdata_' || ym || '.parquet' END
             AS url,
           CASE WHEN month_ok AND starts_with(rtrim(base, '/'), '/Volumes/')
                THEN rtrim(base, '/') || '/year=' || substr(ym, 1, 4) || '/month='
                     || substr(ym, 6, 2) || '/yellow_tripdata_' || ym || '.parquet' END AS path,
           CASE WHEN month_ok AND starts_with(rtrim(base, '/'), '/Volumes/') THEN ym END
             AS path_month,
           CASE WHEN starts_with(base, '/Volumes/') AND len(seg) >= 3 THEN seg[1] END AS catalog,
           CASE WHEN starts_with(base, '/Volumes/') AND len(seg) >= 3 THEN seg[2] END AS schema,
           CASE WHEN starts_with(base, '/Volumes/') AND len(seg) >= 3 THEN seg[3] END AS volume
    FROM p
    """,
)
def landing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses, landing paths and their parts, from good and bad bases and months."""
    ym = months.year_month("o_orderdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _pick(F.col("o_custkey"), *BASES).alias("base"),
        F.when(F.col("o_orderkey") % 5 == 0, F.regexp_replace(ym, "-0", "-"))
        .otherwise(ym)
        .alias("ym"),
    )
    built = orders.select(
        "o_orderkey",
        paths.build_source_url("ym", strict=False).alias("url"),
        paths.build_volume_object_path("base", "ym", strict=False).alias("path"),
        paths.parse_volume_base("base", strict=False).alias("b"),
    )
    return built.select(
        "o_orderkey",
        "url",
        "path",
        paths.parse_volume_object_path("path").alias("path_month"),
        "b.catalog",
        "b.schema",
        "b.volume",
    )


@query(
    "file_month_extract",
    r"""
    WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym,
                      strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m
               FROM orders),
    f AS (SELECT o_orderkey, CASE o_orderkey % 8
        WHEN 0 THEN 'yellow_tripdata_' || ym || '.parquet'
        WHEN 1 THEN '/lake/year=' || y || '/month=' || m || '/yellow_tripdata_' || ym || '.parquet'
        WHEN 2 THEN 's3://b/year=' || y || '/month=' || m || '/yellow_tripdata_' || ym || '.parquet'
        WHEN 3 THEN '/lake/year=' || y || '/month=' || m || '/green_tripdata_' || ym || '.parquet'
        WHEN 4 THEN '/lake/year=' || y || '/month=' || m || '/yellow_tripdata_' || y || '-13.parquet'
        WHEN 5 THEN '/lake/year=2099/month=01/yellow_tripdata_' || ym || '.parquet'
        WHEN 6 THEN ''
        END AS path FROM t),
    e AS (SELECT *, nullif(regexp_extract(path,
             'yellow_tripdata_(\d{4}-(?:0[1-9]|1[0-2]))\.parquet', 1), '') AS file_year_month
          FROM f)
    SELECT o_orderkey, file_year_month,
           CASE WHEN regexp_matches(path, '/year=\d{4}/month=(?:0[1-9]|1[0-2])/yellow_tripdata_\d{4}-(?:0[1-9]|1[0-2])\.parquet$')
                THEN file_year_month END AS landed_year_month
    FROM e
    """,
)
def file_month_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ym = months.year_month("o_orderdate")
    folder = F.concat(
        F.lit("/year="), F.substring(ym, 1, 4), F.lit("/month="), F.substring(ym, 6, 2), F.lit("/")
    )
    name = F.concat(F.lit("yellow_tripdata_"), ym, F.lit(".parquet"))
    path = _pick(
        F.col("o_orderkey"),
        name,
        F.concat(F.lit("/lake"), folder, name),
        F.concat(F.lit("s3://b"), folder, name),
        F.concat(F.lit("/lake"), folder, F.lit("green_tripdata_"), ym, F.lit(".parquet")),
        F.concat(
            F.lit("/lake"),
            folder,
            F.lit("yellow_tripdata_"),
            F.substring(ym, 1, 4),
            F.lit("-13.parquet"),
        ),
        F.concat(F.lit("/lake/year=2099/month=01/"), name),
        "",
        F.lit(None).cast("string"),
    )
    files = table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))
    return files.select(
        "o_orderkey",
        paths.extract_file_year_month("path").alias("file_year_month"),
        paths.parse_volume_object_path("path").alias("landed_year_month"),
    )


STATUS_CODES = (200, 204, 299, 301, 404, 503)
ERROR_NAMES = ("ReadTimeout", "ConnectTimeout", "SSLError", "ConnectionError")


def _case_sql(key: str, *values: str) -> str:
    """The SQL counterpart of :func:`_pick`."""
    whens = " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values))
    return f"CASE {key} % {len(values)} {whens} END"


def _code_sql(key: str) -> str:
    return _case_sql(key, *[str(code) for code in STATUS_CODES])


def _error_sql(key: str) -> str:
    return _case_sql(key, *[f"'{name}'" for name in ERROR_NAMES])


PROBE_STATUS_SQL = """CASE WHEN error_name LIKE '%Timeout%' THEN 'TIMEOUT'
    WHEN error_name IS NOT NULL THEN 'CONN_ERR'
    WHEN code BETWEEN 200 AND 299 THEN 'OK' ELSE 'HTTP_ERR' END"""


@query(
    "probe_classify",
    f"""
    WITH p AS (
      SELECT event_id, {_code_sql('user_id')} AS code,
             CASE WHEN event_type = 'error' THEN {_error_sql('event_id')} END AS error_name
      FROM events)
    SELECT event_id, {PROBE_STATUS_SQL} AS probe_status,
           CASE WHEN error_name IS NULL THEN CAST(code AS INT) END AS http_code
    FROM p
    """,
)
def probe_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a probe log: error events got no answer, others a status code."""
    log_rows = table(spark, sf_dir, "events").select(
        "event_id",
        _pick(F.col("user_id"), *[F.lit(c) for c in STATUS_CODES]).alias("code"),
        F.when(F.col("event_type") == "error", _pick(F.col("event_id"), *ERROR_NAMES)).alias(
            "error_name"
        ),
    )
    return log_rows.select(
        "event_id", outcomes.classify_probe("code", "error_name").alias("p")
    ).select(
        "event_id",
        outcomes.require_in("p.probe_status", outcomes.PROBE_STATUSES, "probe_status").alias(
            "probe_status"
        ),
        "p.http_code",
    )


def _order_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one probe-and-download attempt of its month by its customer's run."""
    key = F.col("o_orderkey")
    attempts = table(spark, sf_dir, "orders").select(
        key.alias("seq"),
        F.concat(F.lit("r"), F.col("o_custkey")).alias("run_id"),
        months.year_month("o_orderdate").alias("month"),
        outcomes.classify_probe(
            _pick(key, *[F.lit(c) for c in STATUS_CODES]),
            F.when(F.col("o_orderpriority") == "1-URGENT", _pick(key, *ERROR_NAMES)),
        ).alias("probe"),
        (F.col("o_orderstatus") != "F").alias("download_ok"),
        F.floor("o_totalprice").alias("bytes_written"),
        F.when(F.col("o_custkey") % 3 == 0, F.floor(F.col("o_totalprice") / 2)).alias("existing"),
    )
    decided = outcomes.month_outcome(
        "probe.probe_status", "download_ok", "bytes_written", "existing"
    )
    return attempts.withColumn("outcome", decided).select(
        "seq", "run_id", "month", "outcome.*", "probe.*"
    )


OUTCOMES_SQL = f"""
attempts AS (
  SELECT o_orderkey AS seq, 'r' || o_custkey AS run_id, strftime(o_orderdate, '%Y-%m') AS month,
         {_code_sql('o_orderkey')} AS code,
         CASE WHEN o_orderpriority = '1-URGENT' THEN {_error_sql('o_orderkey')} END
           AS error_name,
         o_orderstatus <> 'F' AS download_ok,
         CAST(floor(o_totalprice) AS BIGINT) AS written,
         CASE WHEN o_custkey % 3 = 0 THEN CAST(floor(o_totalprice / 2) AS BIGINT) ELSE 0 END
           AS existing
  FROM orders),
probed AS (
  SELECT *, {PROBE_STATUS_SQL} AS probe_status,
         CASE WHEN error_name IS NULL THEN CAST(code AS INT) END AS http_code FROM attempts),
outcomes AS (
  SELECT seq, run_id, month,
         CASE WHEN probe_status = 'OK' AND download_ok THEN 'DOWNLOADED'
              WHEN existing > 0 THEN 'SKIPPED_EXISTING' ELSE 'FAILED' END AS status,
         CASE WHEN probe_status = 'OK' AND download_ok THEN written ELSE 0 END
           AS bytes_downloaded,
         CASE WHEN probe_status = 'OK' AND download_ok THEN written
              WHEN existing > 0 THEN existing ELSE 0 END AS bytes_in_volume,
         probe_status, http_code
  FROM probed)"""


@query("month_outcome", f"WITH {OUTCOMES_SQL} SELECT * FROM outcomes")
def month_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_outcomes(spark, sf_dir)


RUN_AUDIT_SQL = f"""
WITH {RUNS_SQL}, {OUTCOMES_SQL},
last_outcome AS (
  SELECT run_id, month, arg_max(status, seq) AS status,
         arg_max(bytes_downloaded, seq) AS bytes_downloaded,
         arg_max(bytes_in_volume, seq) AS bytes_in_volume,
         arg_max(probe_status, seq) AS probe_status,
         arg_max(coalesce(http_code, -1), seq) AS http_code
  FROM outcomes GROUP BY run_id, month),
inside AS (
  SELECT o.* FROM last_outcome o JOIN runs r ON o.run_id = r.run_id
  WHERE o.month BETWEEN r.start_year_month AND r.end_year_month),
folded AS (
  SELECT run_id,
         string_agg(CASE WHEN status = 'DOWNLOADED' THEN month END, ',' ORDER BY month) AS dl,
         string_agg(CASE WHEN status = 'SKIPPED_EXISTING' THEN month END, ',' ORDER BY month) AS sk,
         string_agg(CASE WHEN status = 'FAILED' THEN month END, ', ' ORDER BY month) AS fl,
         string_agg(month || ':' || probe_status || ':' || http_code, ',' ORDER BY month) AS pr,
         count(*) FILTER (WHERE status <> 'FAILED') AS landed,
         sum(bytes_downloaded) AS bd, sum(bytes_in_volume) AS bv
  FROM inside GROUP BY run_id),
requested AS (
  SELECT run_id, string_agg(strftime(m, '%Y-%m'), ',' ORDER BY m) AS rq
  FROM (SELECT run_id, unnest(generate_series(CAST(start_year_month || '-01' AS DATE),
                                              CAST(end_year_month || '-01' AS DATE),
                                              INTERVAL 1 MONTH)) AS m FROM runs) GROUP BY 1)
SELECT r.run_id, job_run_id, job_url, pipeline_update_id, job_start_ts, job_end_ts, source_mode,
       coalesce(pr, '') AS probe_results, start_year_month, end_year_month,
       rq AS months_requested, coalesce(dl, '') AS months_downloaded,
       coalesce(sk, '') AS months_skipped, coalesce(replace(fl, ' ', ''), '') AS months_failed,
       CAST(coalesce(bd, 0) AS BIGINT) AS bytes_downloaded,
       CAST(coalesce(bv, 0) AS BIGINT) AS bytes_total_in_volume,
       CASE WHEN fl IS NULL THEN 'SUCCESS' WHEN landed = 0 THEN 'FAILED' ELSE 'PARTIAL' END
         AS status,
       CASE WHEN fl IS NULL THEN NULL
            WHEN landed = 0 THEN '{runs.ALL_FAILED_TEXT}' || fl || '{runs.ALL_FAILED_HINT}'
            ELSE '{runs.SOME_FAILED_TEXT}' || fl END AS error_message
FROM runs r JOIN requested q ON r.run_id = q.run_id LEFT JOIN folded f ON r.run_id = f.run_id
"""


@query("run_audit", RUN_AUDIT_SQL)
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All audit columns of every customer's run, lists written as text."""
    audit = runs.collapse_runs(
        customer_runs(spark, sf_dir).drop("o_custkey"), _order_outcomes(spark, sf_dir)
    )
    return audit_as_text(audit)


def audit_as_text(audit: DataFrame) -> DataFrame:
    """All audit columns, with lists written as text."""
    probes = F.transform(
        "probe_results",
        lambda p: F.concat_ws(
            ":", p["month"], p["probe_status"], F.coalesce(p["http_code"], F.lit(-1))
        ),
    )
    lists = ("months_requested", "months_downloaded", "months_skipped", "months_failed")
    return plain(
        audit.withColumns(
            {"probe_results": F.array_join(probes, ",")}
            | {c: F.array_join(c, ",") for c in lists}
        )
    )


@query(
    "audit_completion",
    f"""
    WITH {RUNS_SQL},
    c AS (SELECT o_custkey, 'c' || o_orderkey AS filled_id,
                 row_number() OVER (PARTITION BY o_custkey
                                    ORDER BY o_orderdate, 'c' || o_orderkey) AS rn
          FROM orders WHERE o_orderpriority = '2-HIGH')
    SELECT run_id, job_run_id, job_start_ts,
           coalesce(pipeline_update_id, filled_id) AS pipeline_update_id
    FROM runs LEFT JOIN c ON runs.o_custkey = c.o_custkey AND rn = 1
    """,
)
def audit_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every high-priority order completes its customer's run; the first one counts."""
    audit = customer_runs(spark, sf_dir)
    done = table(spark, sf_dir, "orders").where("o_orderpriority = '2-HIGH'")
    completions = done.join(audit, "o_custkey").select(
        *runs.AUDIT_KEY,
        F.concat(F.lit("c"), F.col("o_orderkey")).alias("pipeline_update_id"),
        F.col("o_orderdate").cast("timestamp").alias("completed_ts"),
    )
    filled = runs.with_completions(audit, completions)
    return plain(filled.select(*runs.AUDIT_KEY, "pipeline_update_id"))


EVENT_NAMES = {
    "click": log.FLOW_PROGRESS,
    "view": log.EXPECTATION_METRICS,
    "purchase": log.PIPELINE_DONE,
    "signup": log.CREATE_UPDATE,
}


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a run-event log; errors are events nobody looks at."""
    kind = F.col("event_type")
    renamed = F.coalesce(*[F.when(kind == k, v) for k, v in EVENT_NAMES.items()], kind)
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        renamed.alias("event_type"),
        F.concat(F.lit("event "), F.col("event_id")).alias("message"),
        F.col("props").alias("details"),
        F.struct(F.concat(F.lit("u"), F.col("user_id")).alias("update_id")).alias("origin"),
    )


RENAMED_SQL = (
    "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_NAMES.items()) + " END"
)


@query(
    "observability_view",
    f"""
    SELECT ts AS timestamp, {RENAMED_SQL} AS event_type, 'event ' || event_id AS message,
           props AS details
    FROM events WHERE event_type IN ('click', 'view', 'purchase')
    ORDER BY timestamp DESC
    """,
)
def observability_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.observability(_event_log(spark, sf_dir))


@query(
    "latest_update",
    """
    SELECT 'u' || user_id AS update_id FROM events WHERE event_type = 'signup'
    ORDER BY ts DESC, 'u' || user_id DESC LIMIT 1
    """,
)
def latest_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log.latest_update_id(_event_log(spark, sf_dir))


@query(
    "pending_completion",
    f"""
    WITH {RUNS_SQL}
    SELECT run_id, job_run_id, job_start_ts,
           (SELECT 'u' || user_id FROM events WHERE event_type = 'signup'
            ORDER BY ts DESC, 'u' || user_id DESC LIMIT 1) AS pipeline_update_id,
           (SELECT max(ts) FROM events) AS completed_ts
    FROM runs
    WHERE job_run_id = (SELECT min(job_run_id) FROM runs WHERE pipeline_update_id IS NULL)
      AND pipeline_update_id IS NULL
    """,
)
def pending_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows a late fill of one incomplete job run would append."""
    audit = customer_runs(spark, sf_dir)
    newest = table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    job = audit.where("pipeline_update_id IS NULL").agg(F.min("job_run_id")).scalar()
    update = log.latest_update_id(_event_log(spark, sf_dir)).scalar()
    return plain(runs.pending_completion(audit, job, update, newest))
