"""Queries for the scalar expressions.

Parsing expressions are checked as round trips: report lines are rendered from
the execution/alert views in the reference's report layouts, parsed back with
the library's expressions, and the oracle is simply the original typed values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscope.functions import text as T
from jobscope.functions import thresholds as TH
from jobscope.functions import timefmt as TF
from jobscope.plans.registry import register
from jobscope.sources.fixtures import Estate

# Layout of the execution report (13 positional fields, ',' separated,
# quoted dates): centre, folder, application, group, node, job, odate,
# start, end, rerun counter, status, average cpu, order id.
EXEC_REPORT_SCHEMA = ("c1 STRING, c2 STRING, c3 STRING, c4 STRING, c5 STRING, c6 STRING, c7 STRING, c8 STRING, "
                      "c9 STRING, c10 STRING, c11 STRING, c12 STRING, c13 STRING")


def _q(c):
    return F.concat(F.lit('"'), c, F.lit('"'))


def exec_report_lines(e):
    """Render executions as report lines: odate ``"May 20, 2025"``, start
    ``"May 20 2025 03:04:05 PM"``, end with the comma kept (both forms occur)."""
    line = F.concat_ws(",", F.concat(F.lit(" "), F.col("data_center"), F.lit(" ")), "sched_table", F.lit("APP"),
                       F.lit("GRP"), F.lit("N1"), "job_name",
                       _q(F.date_format("start_time", "MMM d, yyyy")),
                       _q(F.date_format("start_time", "MMM dd yyyy hh:mm:ss a")),
                       _q(F.date_format("end_time", "MMM d, yyyy h:mm:ss a")),
                       F.col("rerun_counter").cast("string"), "completion_status", F.lit("0"), "order_id")
    return e.select("exec_id", line.alias("line"))


def parse_exec_report(lines):
    """S2 mapping of the execution report: F2 then quoted-CSV split, F3 trim, F5 parse, F7 duration."""
    cleaned = lines.select("exec_id", T.drop_comma_in_date("line").alias("line"))
    rec = cleaned.select("exec_id", F.from_csv("line", EXEC_REPORT_SCHEMA, {"sep": ",", "quote": '"'}).alias("r"))
    start = TF.parse_report_ts(F.trim("r.c8"))
    end = TF.parse_report_ts(F.trim("r.c9"))
    return rec.select("exec_id", F.trim("r.c1").alias("data_center"), F.trim("r.c6").alias("job_name"),
                      TF.parse_date(T.drop_commas(F.trim("r.c7")), TF.REPORT_DATE).alias("odate"),
                      start.alias("start_time"), end.alias("end_time"),
                      F.trim("r.c10").try_cast("int").alias("rerun_counter"),
                      F.trim("r.c13").alias("order_id"), TF.duration_s(end, start).alias("runtime_s"))


@register("s2_f2_f5_exec_report_parse", sql="""
SELECT exec_id, data_center, job_name, CAST(start_time AS DATE) AS odate, start_time, end_time,
       CAST(rerun_counter AS INTEGER) AS rerun_counter, order_id, runtime_s FROM fx_exec""", views=("fx_exec",))
def q_exec_report(spark, sf):
    return parse_exec_report(exec_report_lines(Estate(spark, sf).exec))


def alert_report_lines(a):
    """Render alerts in the 19-field quoted alert layout; blanks for empty fields."""
    f = [_q(F.col("alert_id").cast("string")), _q(F.lit("")), _q(F.col("server_name")), _q(F.lit("")),
         _q(F.lit("agent")), _q(F.lit("")), _q(F.lit("")), _q(F.col("job_name")), _q(F.lit("mgr")),
         _q(F.col("run_id")), _q(F.lit("3")), _q(F.coalesce(F.col("notes"), F.lit(""))),
         _q(F.date_format("alert_time", "dd-MM-yy HH:mm:ss")), _q(F.date_format("alert_time", "dd-MM-yy HH:mm:ss")),
         _q(F.lit("")), _q(F.lit("")), _q(F.col("run_counter").cast("string")), _q(F.lit("")), _q(F.lit(""))]
    return a.select(F.concat_ws(",", *f).alias("line"))


@register("s2_f1_f4_f5_alert_report_parse", sql="""
SELECT CAST(alert_id AS VARCHAR) AS serial, NULL::VARCHAR AS alert_key, server_name AS node, job_name AS application,
       run_id AS server, notes AS summary, alert_time AS first_occurrence, alert_time AS last_occurrence,
       CAST(run_counter AS VARCHAR) AS tally FROM fx_alert""", views=("fx_alert",))
def q_alert_report(spark, sf):
    lines = alert_report_lines(Estate(spark, sf).alert)
    # F1 as the reference does it: quotes removed from the whole line, then split on ','
    parts = F.split(T.strip_quotes("line"), ",")
    g = [T.blank_to_null(F.get(parts, i)) for i in range(19)]
    return lines.select(g[0].alias("serial"), g[1].alias("alert_key"), g[2].alias("node"),
                        g[7].alias("application"), g[9].alias("server"), g[11].alias("summary"),
                        TF.parse_ts(g[12], TF.ALERT_TS).alias("first_occurrence"),
                        TF.parse_ts(g[13], TF.ALERT_TS).alias("last_occurrence"), g[16].alias("tally"))


@register("f5_f6_long_and_compact_times", sql="""
SELECT alert_id, strftime(alert_time, '%Y%m%d%H%M%S') AS compact, strftime(alert_time, '%d/%m/%Y %H:%M:%S') AS display,
       strftime(alert_time, '%Y-%m-%d') AS day, alert_time AS reparsed FROM fx_alert""", views=("fx_alert",))
def q_times(spark, sf):
    a = Estate(spark, sf).alert_plain
    long_text = F.date_format("alert_time", "MMMM d, yyyy h:mm:ss a")
    reparsed = TF.parse_ts(long_text, TF.LONG_TS)
    compact = TF.format_ts(reparsed, TF.COMPACT_TS)
    return a.select("alert_id", compact.alias("compact"), TF.format_ts("alert_time", TF.DISPLAY_TS).alias("display"),
                    TF.format_ts("alert_time", "yyyy-MM-dd").alias("day"),
                    TF.parse_ts(compact, TF.COMPACT_TS).alias("reparsed"))


@register("f7_durations_hms", sql="""
SELECT exec_id, date_diff('second', start_time, end_time) AS runtime_s,
       printf('%02d:%02d:%02d', runtime_s // 3600, (runtime_s % 3600) // 60, runtime_s % 60) AS hms,
       runtime_s AS back_s FROM fx_exec""", views=("fx_exec",))
def q_durations(spark, sf):
    e = Estate(spark, sf).runs
    hms = TF.sec_to_time("runtime_s")
    return e.select("exec_id", TF.duration_s("end_time", "start_time").alias("runtime_s"), hms.alias("hms"),
                    TF.time_to_sec(hms).alias("back_s"))


@register("f8_f9_f21_threshold_values", sql="""
SELECT id, valor_correto,
  CASE WHEN starts_with(valor_correto, '=') THEN TRY_CAST(substring(valor_correto, 2) AS BIGINT) * 60
       WHEN starts_with(valor_correto, '+') THEN CAST(floor(CAST(media_s AS DOUBLE) + CAST(media_s AS DOUBLE) * (CAST(TRY_CAST(substring(valor_correto, 2, length(valor_correto) - 2) AS BIGINT) AS DOUBLE) / 100)) AS BIGINT)
       ELSE NULL END AS new_time_s,
  concat('=', CAST(CAST(floor((media_s * 1.5 + 1800) / 60) AS BIGINT) AS VARCHAR)) AS recommended,
  CASE WHEN TRY_CAST(replace(concat('+', CAST(media_s AS VARCHAR), '%'), '%', '') AS BIGINT) > 999 THEN '+30%'
       ELSE concat('+', CAST(media_s AS VARCHAR), '%') END AS capped_pct,
  CASE WHEN TRY_CAST(replace(valor_correto, '%', '') AS BIGINT) > 999 THEN '+30%' ELSE valor_correto END AS capped
FROM fx_shout_sum""", views=("fx_shout_sum",))
def q_thresholds(spark, sf):
    s = Estate(spark, sf).shout_sum
    pct_text = F.concat(F.lit("+"), F.col("media_s").cast("string"), F.lit("%"))
    return s.select("id", "valor_correto", TH.effective_threshold("valor_correto", "media_s").alias("new_time_s"),
                    TH.recommended_threshold("media_s").alias("recommended"),
                    T.cap_threshold(pct_text).alias("capped_pct"), T.cap_threshold("valor_correto").alias("capped"))


@register("f10_f12_app_code_platform", sql="""
SELECT exec_id,
  trim(CASE WHEN rtrim(substring(job_name, 1, 3)) = 'M' THEN substring(job_name, 1, 2) ELSE substring(job_name, 1, 3) END) AS sigla_m,
  trim(CASE WHEN rtrim(substring(job_name, 1, 3)) = 'P' THEN substring(job_name, 1, 2) ELSE substring(job_name, 1, 3) END) AS sigla_p,
  trim(CASE WHEN substring(job_name, 1, 1) = 'M' THEN substring(job_name, 1, 2) ELSE substring(job_name, 1, 3) END) AS sigla_m1,
  CASE WHEN substring(data_center, 1, 2) = 'DS' THEN 'DISTRIBUIDA' ELSE 'MAINFRAME' END AS plataforma,
  substring(data_center, 1, 2) AS ambiente FROM fx_exec""", views=("fx_exec",))
def q_codes(spark, sf):
    e = Estate(spark, sf).runs
    return e.select("exec_id", T.app_code("job_name", "M").alias("sigla_m"), T.app_code("job_name", "P").alias("sigla_p"),
                    T.app_code("job_name", "M", test_len=1).alias("sigla_m1"),
                    T.platform("data_center").alias("plataforma"), T.platform_prefix("data_center").alias("ambiente"))


@register("f11_f16_last3_and_keys", sql="""
SELECT c_custkey, CASE WHEN length(c_name) >= 3 THEN trim(right(c_name, 3)) ELSE '' END AS sigla,
       concat(c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS service_lob FROM customer""")
def q_last3(spark, sf):
    c = Estate(spark, sf).table("customer")
    return c.select("c_custkey", T.last3("c_name").alias("sigla"),
                    T.concat_fields("c_mktsegment", F.col("c_nationkey").cast("string")).alias("service_lob"))


@register("f16_resource_key", sql="""
SELECT alert_id, concat_ws('-', server_name, CAST(run_counter AS VARCHAR), run_id) AS resource,
       concat(server_name, ':', run_id) AS job_id FROM fx_alert""", views=("fx_alert",))
def q_resource(spark, sf):
    a = Estate(spark, sf).alert
    return a.select("alert_id", T.resource_key("server_name", "run_counter", "run_id").alias("resource"),
                    T.concat_fields("server_name", F.lit(":"), "run_id").alias("job_id"))


@register("f13_f14_criticality", sql="""
SELECT job_id,
  CASE WHEN substring(group_name, 1, 1) = 'A' THEN 'High' WHEN substring(group_name, 1, 1) = 'M' THEN 'Moderate'
       WHEN substring(group_name, 1, 1) = 'B' THEN 'Low' ELSE NULL END AS criticality,
  CASE WHEN substring(group_name, 1, 1) = 'A' THEN 'High' WHEN substring(group_name, 1, 1) = 'M' THEN 'Moderate'
       WHEN substring(group_name, 1, 1) = 'B' THEN 'Low'
       WHEN substring(group_name, 1, 1) NOT IN ('High', 'Moderate', 'Low', 'Urgent') THEN 'R'
       ELSE substring(group_name, 1, 1) END AS normalised,
  CASE WHEN cyclic = 'Y' THEN NULL ELSE 'Urgent' END AS kept
FROM fx_def_job""", views=("fx_def_job",))
def q_criticality(spark, sf):
    j = Estate(spark, sf).def_job
    return j.select("job_id", T.criticality("group_name").alias("criticality"),
                    T.normalise_criticality(F.substring("group_name", 1, 1)).alias("normalised"),
                    T.normalise_criticality(F.when(F.col("cyclic") != "Y", F.lit("Urgent"))).alias("kept"))


# Fixed recodes of the notification report "when" phrases.
WHEN_PHRASES = {"Job execution time": "EXECTIME", "Job not submitted by spec": "LATESUB",
                "Job not finished by speci": "LATEEXEC"}
# Fixed audit status codes.
STATUS_CODES = {"NOF": -1, "Error": 0, "OK": 1, "NOK": 2}


@register("f15_recode", sql="""
WITH r AS (SELECT id, CASE when_cond WHEN 'EXECUTING' THEN 'Job execution time' WHEN 'LATESUB' THEN 'Job not submitted by spec'
                      ELSE 'Job not finished by speci' END AS phrase,
                  CASE id % 4 WHEN 0 THEN 'NOF' WHEN 1 THEN 'OK' WHEN 2 THEN 'NOK' ELSE 'Error' END AS status FROM fx_shout)
SELECT id, CASE phrase WHEN 'Job execution time' THEN 'EXECTIME' WHEN 'Job not submitted by spec' THEN 'LATESUB'
                WHEN 'Job not finished by speci' THEN 'LATEEXEC' ELSE phrase END AS when_code,
       CASE status WHEN 'NOF' THEN -1 WHEN 'Error' THEN 0 WHEN 'OK' THEN 1 WHEN 'NOK' THEN 2 ELSE 0 END AS status_id
FROM r""", views=("fx_shout",))
def q_recode(spark, sf):
    s = Estate(spark, sf).shout
    phrase = (F.when(F.col("when_cond") == "EXECUTING", "Job execution time")
              .when(F.col("when_cond") == "LATESUB", "Job not submitted by spec")
              .otherwise("Job not finished by speci"))
    status = F.element_at(F.array(F.lit("NOF"), F.lit("OK"), F.lit("NOK"), F.lit("Error")),
                          (F.col("id") % 4 + 1).cast("int"))
    r = s.select("id", phrase.alias("phrase"), status.alias("status"))
    return r.select("id", T.recode("phrase", WHEN_PHRASES).alias("when_code"),
                    T.recode("status", STATUS_CODES, default=0).cast("int").alias("status_id"))


@register("f17_f18_f19_incident_fields", sql="""
SELECT number, json_extract_string(u_additional_info, '$.JOBNAME_ADDINFO') AS job_name,
       CASE WHEN regexp_full_match(substring(number, 4), '[0-9]+') THEN CAST(substring(number, 4) AS BIGINT) ELSE 0 END AS inc_no,
       CASE WHEN regexp_full_match(u_alert_id, '[0-9]+') THEN CAST(u_alert_id AS BIGINT) ELSE 0 END AS alert_no
FROM fx_incident""", views=("fx_incident",))
def q_incident_fields(spark, sf):
    i = Estate(spark, sf).incident
    return i.select("number", T.json_field("u_additional_info", "$.JOBNAME_ADDINFO").alias("job_name"),
                    T.digits_or_zero(F.substring("number", 4, 1 << 20)).alias("inc_no"),
                    T.digits_or_zero("u_alert_id").alias("alert_no"))


@register("f18_incident_in_notes", sql="""
SELECT alert_id, CASE WHEN upper(notes) LIKE '%INC%' AND strpos(notes, 'INC') > 0 THEN substring(notes, strpos(notes, 'INC')) END AS inc,
       CASE WHEN upper(lower(notes)) LIKE '%INC%' AND strpos(lower(notes), 'INC') > 0 THEN 'x' END AS lower_inc
FROM fx_alert""", views=("fx_alert",))
def q_notes(spark, sf):
    a = Estate(spark, sf).alert_plain
    low = T.incident_in_notes(F.lower("notes"))
    return a.select("alert_id", T.incident_in_notes("notes").alias("inc"),
                    F.when(low.isNotNull(), F.lit("x")).alias("lower_inc"))


@register("f20_failed_ids", sql="""
WITH m AS (SELECT alert_id, concat('Failed for alerts [', CAST(alert_id AS VARCHAR), ', ', CAST(run_counter AS VARCHAR), ']') AS message FROM fx_alert),
u AS (SELECT alert_id, unnest(string_split(regexp_extract(message, '\\[([^\\]]*)', 1), ',')) AS part FROM m)
SELECT alert_id, TRY_CAST(trim(part) AS BIGINT) AS failed_id FROM u WHERE TRY_CAST(trim(part) AS BIGINT) IS NOT NULL""",
          views=("fx_alert",))
def q_failed_ids(spark, sf):
    a = Estate(spark, sf).alert
    m = a.select("alert_id", F.concat(F.lit("Failed for alerts ["), F.col("alert_id").cast("string"), F.lit(", "),
                                      F.col("run_counter").cast("string"), F.lit("]")).alias("message"))
    return m.select("alert_id", F.explode(T.failed_ids("message")).alias("failed_id"))


@register("f22_jitter_small", sql="""
SELECT exec_id, runtime_s, CASE WHEN runtime_s <= 1440 THEN CAST('0x' || substr(md5(concat_ws('|', '42', exec_id, runtime_s)), 1, 8) AS BIGINT) % 9 + 50
  ELSE runtime_s END AS modelled_s FROM fx_exec""", views=("fx_exec",))
def q_jitter(spark, sf):
    e = Estate(spark, sf).runs
    return e.select("exec_id", "runtime_s", TF.jitter_small("runtime_s", key=["exec_id"]).alias("modelled_s"))


@register("f23_replace_prefix", sql="""
SELECT job_id, CASE WHEN group_name LIKE 'M-%' THEN replace(group_name, 'M-', 'MOD-') ELSE group_name END AS group_name,
       CASE WHEN node_id LIKE 'Brand#1%' THEN 'Z' ELSE node_id END AS node_group FROM fx_def_job""", views=("fx_def_job",))
def q_replace_prefix(spark, sf):
    j = Estate(spark, sf).def_job
    return j.select("job_id", T.replace_prefix("group_name", "M-%", new="MOD-", old="M-").alias("group_name"),
                    T.replace_prefix("node_id", "Brand#1%", new="Z").alias("node_group"))
