"""Registered evaluation, monitoring, dataset and presentation jobs.

Evaluation rows, trace marks and the query log are read out of the events
table; golden rows out of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.catalog.entry import ROLES, Entry, with_ctes
from storelens.operators.ranking import number_rows_per_group
from storelens.operators.sampling import exact_split, quotas, stratified_sample
from storelens.plans import dataset, evaluation, monitoring, orders, presentation
from storelens.sources.star import Star
from storelens.sources.tables import table

MODELS = ("baseline", "finetuned")

# Text that Spark SQL and DuckDB read alike.
DIFFICULTY = "CASE event_id % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END"
MODEL = "CASE WHEN event_id % 2 = 0 THEN 'baseline' ELSE 'finetuned' END"
# Results may carry any label, also none, or the name of the overall row.
ODD_LABELS = """CASE WHEN id % 17 = 0 THEN 'all' WHEN id % 19 = 0 THEN NULL WHEN id % 23 = 0 THEN 'odd' ELSE difficulty END"""
QUESTION = """concat('What did user ', user_id, ' do on day ', day(ts), ' of the month',
    CASE WHEN user_id % 2 = 0 THEN ', and how much was spent?' ELSE '?' END)"""
LONG_SQL = """concat('SELECT ', repeat('value, ', CAST(event_id % 60 AS INT)), 'ts FROM EVENTS WHERE USER_ID = ', user_id)"""

RESULT_COLUMNS = f"""event_id AS id, {QUESTION} AS question, {DIFFICULTY} AS difficulty, {MODEL} AS model,
    event_type <> 'error' AS success, value AS latency, {LONG_SQL} AS sql,
    CASE WHEN event_type = 'error' THEN concat('Error: at ', value) END AS error,
    event_type <> 'signup' AS tables_found, event_id % 4 = 0 AS uses_qualified_names,
    CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN {LONG_SQL} ELSE 'SELECT 1' END AS first_sql"""

CTES = {
    "w_results": f"SELECT {RESULT_COLUMNS} FROM events",
    "w_marks": """
        SELECT user_id AS query_id, event_id AS mark_id, ts,
               CASE event_type WHEN 'view' THEN 'start' ELSE 'end' END AS kind,
               concat('agent ', event_id % 3) AS agent,
               CASE WHEN value > 45 THEN 'error' ELSE 'success' END AS status
        FROM events WHERE event_type IN ('view', 'purchase')""",
    "w_answers": """
        SELECT c_custkey AS query_id, concat('What did ', c_name, ' buy?') AS question,
               concat('SELECT * FROM ORDERS WHERE CUSTOMER_ID = ', c_custkey) AS final_sql,
               CASE WHEN c_acctbal > 0 THEN c_nationkey END AS row_count,
               CASE WHEN c_acctbal <= 0 THEN 'timeout' END AS error
        FROM customer""",
    "w_log": f"""
        SELECT event_id AS query_id, ts, {QUESTION} AS question, event_type <> 'error' AS success,
               CAST(floor(value * 4) AS BIGINT) AS link_ms, CAST(floor(value * 6) AS BIGINT) AS validate_ms,
               CASE WHEN event_id % 9 = 0 THEN 'ok (after retries)' ELSE 'ok' END AS validate_detail,
               CASE WHEN event_type <> 'error' THEN user_id END AS row_count
        FROM events""",
    "w_golden": """
        SELECT doc_id AS position, text AS question,
               concat('SELECT COUNT(*) FROM ORDERS JOIN RAW.SELLERS ON LANG = ', lang) AS sql_query,
               CASE WHEN doc_id % 5 < 2 THEN 'easy' WHEN doc_id % 5 < 4 THEN 'medium' ELSE 'hard' END AS difficulty
        FROM documents""",
    "w_pairs": """
        SELECT a.conv_id, a.turn, a.text AS input, b.text AS output FROM conversations a
        JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
        WHERE a.role = 'user' AND b.role = 'assistant'""",
    "w_unique": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY question, sql_query ORDER BY position) AS rn
                       FROM w_golden) WHERE rn = 1""",
}


def _from(name: str, source: str):
    """The fixture of that name; its select list is shared with the SQL."""
    text = CTES[name]

    def build(spark, sf_dir) -> DataFrame:
        return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))

    return build


_results = _from("w_results", "events")
_marks = _from("w_marks", "events")
_golden = _from("w_golden", "documents")
_answers = _from("w_answers", "customer")


def _holed(marks: DataFrame) -> DataFrame:
    """Marks of which some have lost their query or their time."""
    return marks.withColumns({
        "query_id": F.when(F.col("mark_id") % 50 != 0, F.col("query_id")),
        "ts": F.when(F.col("mark_id") % 70 != 0, F.col("ts")),
    })


def _log(spark, sf_dir) -> DataFrame:
    flat = _from("w_log", "events")(spark, sf_dir)

    def step(agent: str, millis: str, detail) -> Column:
        return F.struct(
            F.lit(agent).alias("agent"), F.lit("success").alias("status"), F.col(millis).alias("duration_ms"),
            detail.alias("detail"),
        )

    steps = F.array(
        step("Schema Linker", "link_ms", F.lit("ok")), step("Validator", "validate_ms", F.col("validate_detail"))
    )
    return flat.select(
        "query_id", "ts", "question", "success", "row_count", steps.alias("steps"),
        (F.col("link_ms") + F.col("validate_ms")).alias("total_duration_ms"),
    )


def _pairs(spark, sf_dir) -> DataFrame:
    return dataset.conversation_pairs(table(spark, sf_dir, "conversations"))


def _dataset(spark, sf_dir) -> DataFrame:
    return dataset.build(_golden(spark, sf_dir), _pairs(spark, sf_dir))


def _sample(spark, sf_dir) -> DataFrame:
    golden = _golden(spark, sf_dir).select("position", "difficulty")
    return stratified_sample(golden, "difficulty", "position", quotas(50))


def _sql(body: str) -> str:
    return with_ctes(body, CTES)


QUALIFIED = "replace(replace(sql_query, 'FROM ORDERS', 'FROM WAREHOUSE.RAW.ORDERS'), 'JOIN RAW.SELLERS', 'JOIN WAREHOUSE.RAW.SELLERS')"
DATASET_SQL = f"""SELECT '{dataset.INSTRUCTION}' AS instruction, question AS input, {QUALIFIED} AS output,
        difficulty, 'golden' AS source FROM w_unique
    UNION ALL
    SELECT '{dataset.INSTRUCTION}', input, output, 'augmented', 'augmented' FROM w_pairs"""

EVALUATION: dict[str, Entry] = {
    "eval_selection": Entry(
        lambda s, d: evaluation.select_records(_results(s, d), "hard", 25).select("id", "question", "difficulty"),
        _sql("SELECT id, question, difficulty FROM w_results WHERE difficulty = 'hard' ORDER BY id LIMIT 25"),
    ),
    "eval_metrics": Entry(
        lambda s, d: evaluation.metrics(_results(s, d).withColumn("difficulty", F.expr(ODD_LABELS))),
        _sql(
            f"""SELECT CASE GROUPING(difficulty) WHEN 1 THEN 'overall' ELSE 'difficulty' END AS level,
                      CASE GROUPING(difficulty) WHEN 1 THEN 'all' ELSE difficulty END AS difficulty, COUNT(*) AS total,
                      COUNT(*) FILTER (success) AS successful, COUNT(*) FILTER (NOT success) AS failed,
                      CAST(COUNT(*) FILTER (success) AS DOUBLE) / COUNT(*) * 100 AS accuracy,
                      CAST(SUM(CAST(latency AS DECIMAL(12,3))) AS DOUBLE) / COUNT(*) AS average_latency
               FROM (SELECT * REPLACE ({ODD_LABELS} AS difficulty) FROM w_results) GROUP BY ROLLUP (difficulty)"""
        ),
    ),
    "eval_failed": Entry(
        lambda s, d: evaluation.failed_queries(_results(s, d)),
        _sql(
            """SELECT id, question, difficulty, error,
                      sql AS generated_sql,
                      CASE WHEN length(sql) > 200 THEN substr(sql, 1, 200) || '...' ELSE sql END AS short_sql
               FROM w_results WHERE NOT success"""
        ),
    ),
    "eval_outcomes": Entry(
        lambda s, d: evaluation.outcome_counts(
            _results(s, d)
            .withColumn("sql", F.when(F.col("id") % 10 == 3, F.lit(" ")).otherwise(F.col("sql")))
            .withColumn("error", F.when(F.col("id") % 4 == 0, F.lit("Unexpected error: lost")).otherwise(F.col("error")))
        ),
        _sql(
            """SELECT CASE WHEN NOT tables_found THEN 'no tables' WHEN id % 10 = 3 THEN 'empty sql'
                           WHEN success THEN 'success' WHEN id % 4 = 0 THEN 'unexpected' ELSE 'error' END AS outcome,
                      COUNT(*) AS questions
               FROM w_results GROUP BY 1"""
        ),
    ),
    "eval_retried": Entry(
        lambda s, d: evaluation.retried(_results(s, d)).groupBy("retried").agg(F.count("*").alias("questions")),
        _sql("SELECT first_sql IS DISTINCT FROM sql AS retried, COUNT(*) AS questions FROM w_results GROUP BY 1"),
    ),
    "model_summary": Entry(
        lambda s, d: evaluation.model_summary(_results(s, d)),
        _sql(
            """SELECT model, CASE WHEN grouping(difficulty) = 1 THEN 'overall' ELSE 'difficulty' END AS level,
                      CASE WHEN grouping(difficulty) = 1 THEN 'all' ELSE difficulty END AS difficulty, COUNT(*) AS total,
                      COUNT(*) FILTER (success) AS passed, COUNT(*) FILTER (uses_qualified_names) AS qualified,
                      ROUND(CAST(SUM(CAST(latency AS DECIMAL(12,3))) AS DOUBLE) / COUNT(*), 1) AS avg_latency
               FROM w_results GROUP BY GROUPING SETS ((model), (model, difficulty))"""
        ),
    ),
    "model_side_by_side": Entry(
        lambda s, d: evaluation.side_by_side(_results(s, d), MODELS),
        _sql(
            """SELECT question,
                      CASE WHEN length(question) > 55 THEN substr(question, 1, 52) || '...' ELSE question END AS short_question,
                      CASE WHEN arg_min(success, id) FILTER (model = 'baseline') THEN 'PASS' ELSE 'FAIL' END AS baseline,
                      CASE WHEN arg_min(success, id) FILTER (model = 'finetuned') THEN 'PASS' ELSE 'FAIL' END AS finetuned
               FROM w_results GROUP BY w_results.question"""
        ),
    ),
    "model_grid": Entry(
        lambda s, d: evaluation.model_grid(
            _results(s, d).groupBy("question").agg(F.min("difficulty").alias("difficulty")), _results(s, d), MODELS
        ),
        _sql(
            """SELECT q.question, m.model, q.difficulty, coalesce(r.success, false) AS success, coalesce(r.sql, '') AS sql,
                      coalesce(r.latency, 0.0) AS latency,
                      CASE WHEN r.id IS NULL THEN 'not run' ELSE r.error END AS error
               FROM (SELECT question, min(difficulty) AS difficulty FROM w_results GROUP BY question) q
               CROSS JOIN (VALUES ('baseline'), ('finetuned')) m(model)
               LEFT JOIN w_results r ON r.question = q.question AND r.model = m.model"""
        ),
    ),
}

STEPS_SQL = """
SELECT query_id, mark_id, ts, status,
       CASE WHEN before.kind = 'start' THEN before.agent ELSE 'Unknown' END AS agent,
       CASE WHEN before.kind = 'start' THEN (epoch_us(ts) - epoch_us(before.ts)) // 1000 ELSE 0 END AS duration_ms
FROM (SELECT *, LAG({'kind': kind, 'agent': agent, 'ts': ts})
             OVER (PARTITION BY query_id ORDER BY ts, mark_id) AS before FROM w_marks)
WHERE kind = 'end'"""

LABELS = "concat('Q', ROW_NUMBER() OVER (ORDER BY ts, query_id))"

MONITORING: dict[str, Entry] = {
    "trace_steps": Entry(lambda s, d: monitoring.trace_steps(_marks(s, d)), _sql(STEPS_SQL)),
    "trace_records": Entry(
        lambda s, d: monitoring.trace_records(_marks(s, d), _answers(s, d)).withColumn("steps", F.to_json("steps")),
        _sql(
            f"""SELECT query_id, started, step_count, total_duration_ms, success, coalesce(steps, '[]') AS steps,
                       question, final_sql, row_count, error
                FROM (SELECT query_id, min(ts) AS started, COUNT(*) FILTER (kind = 'end') AS step_count,
                             (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS total_duration_ms,
                             COUNT(*) FILTER (kind = 'end' AND status = 'error') = 0 AS success
                      FROM w_marks GROUP BY query_id)
                LEFT JOIN (SELECT query_id, '[' || string_agg('{{"agent":"' || agent || '","status":"' || status
                                  || '","duration_ms":' || duration_ms || '}}', ',' ORDER BY ts, mark_id) || ']' AS steps
                           FROM ({STEPS_SQL}) GROUP BY query_id) USING (query_id)
                LEFT JOIN w_answers USING (query_id)"""
        ),
    ),
    "trace_rejects": Entry(
        lambda s, d: monitoring.rejected_marks(_holed(_marks(s, d))).select("mark_id", "reason"),
        _sql(
            """SELECT mark_id, CASE WHEN mark_id % 50 = 0 THEN 'no query' ELSE 'no time' END AS reason
               FROM w_marks WHERE mark_id % 50 = 0 OR mark_id % 70 = 0"""
        ),
    ),
    "trace_step_pages": Entry(
        lambda s, d: monitoring.step_pages(monitoring.trace_steps(_marks(s, d)), page_rows=2, bucket_seconds=864000)
        .select("query_id", "bucket", "page", F.to_json("steps.agent").alias("agents"),
                F.aggregate("steps.duration_ms", F.lit(0).cast("long"), lambda a, x: a + x).alias("duration_ms")),
        _sql(
            f"""SELECT query_id, bucket, page, concat('["', string_agg(agent, '","' ORDER BY rn), '"]') AS agents,
                       CAST(sum(duration_ms) AS BIGINT) AS duration_ms
                FROM (SELECT *, (rn - 1) // 2 AS page FROM (
                    SELECT *, epoch_us(ts) // 864000000000 AS bucket,
                           ROW_NUMBER() OVER (PARTITION BY query_id, epoch_us(ts) // 864000000000
                                              ORDER BY ts, mark_id) AS rn
                    FROM ({STEPS_SQL})))
                GROUP BY query_id, bucket, page"""
        ),
    ),
    "monitor_summary": Entry(
        lambda s, d: monitoring.summary(_log(s, d)),
        _sql(
            """SELECT COUNT(*) AS total, CAST(COUNT(*) FILTER (success) AS DOUBLE) / COUNT(*) * 100 AS success_rate,
                      CAST(SUM(link_ms + validate_ms) AS DOUBLE) / COUNT(*) AS avg_latency,
                      COUNT(*) FILTER (contains(validate_detail, 'retries')) AS retries
               FROM w_log"""
        ),
    ),
    "monitor_history": Entry(
        lambda s, d: monitoring.history(_log(s, d)),
        _sql(
            """SELECT query_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
                      question,
                      CASE WHEN length(question) > 60 THEN substr(question, 1, 60) || '...' ELSE question END AS short_question,
                      CASE WHEN success THEN 'Success' ELSE 'Error' END AS status,
                      link_ms + validate_ms AS latency_ms, coalesce(row_count, 0) AS rows
               FROM w_log"""
        ),
    ),
    "monitor_latency": Entry(
        lambda s, d: monitoring.latency_series(_log(s, d)),
        _sql(
            f"""SELECT {LABELS} AS label, link_ms + validate_ms AS latency_ms,
                       CASE WHEN success THEN 'Success' ELSE 'Error' END AS status
                FROM w_log"""
        ),
    ),
    "step_breakdown": Entry(
        lambda s, d: monitoring.step_breakdown(_log(s, d)),
        _sql(
            f"""SELECT label, 'Schema Linker' AS agent, link_ms AS duration_ms
                FROM (SELECT *, {LABELS} AS label FROM w_log)
                UNION ALL
                SELECT label, 'Validator', validate_ms FROM (SELECT *, {LABELS} AS label FROM w_log)"""
        ),
    ),
}

DATASET: dict[str, Entry] = {
    "golden_dedup": Entry(
        lambda s, d: dataset.unique_questions(_golden(s, d)),
        _sql("SELECT position, question, sql_query, difficulty FROM w_unique"),
    ),
    "dataset_build": Entry(_dataset, _sql(DATASET_SQL)),
    "dataset_stats": Entry(
        lambda s, d: dataset.counts(_dataset(s, d)),
        _sql(
            f"""SELECT 'source' AS kind, source AS value, COUNT(*) AS records FROM ({DATASET_SQL}) GROUP BY source
                UNION ALL
                SELECT 'difficulty', difficulty, COUNT(*) FROM ({DATASET_SQL}) GROUP BY difficulty"""
        ),
    ),
    "training_text": Entry(
        lambda s, d: dataset.training_texts(_dataset(s, d)).select("source", "text"),
        _sql(
            f"""SELECT source, concat('### Instruction:', chr(10), instruction, chr(10), chr(10), '### Input:', chr(10),
                       input, chr(10), chr(10), '### Response:', chr(10), output, '</s>') AS text
                FROM ({DATASET_SQL})"""
        ),
    ),
    "train_val_split": Entry(
        lambda s, d: exact_split(table(s, d, "documents").select("doc_id"), "doc_id"),
        """SELECT doc_id, CASE WHEN ROW_NUMBER() OVER (ORDER BY md5('42:' || doc_id))
                                    <= floor((SELECT COUNT(*) FROM documents) * 0.9)
                               THEN 'train' ELSE 'val' END AS split
           FROM documents""",
    ),
    "stratified_quota": Entry(
        _sample,
        _sql(
            """SELECT position, difficulty, id, (id - 1) // 5 AS batch
               FROM (SELECT position, difficulty, ROW_NUMBER() OVER (
                         PARTITION BY difficulty ORDER BY md5('42:' || position), position) AS id FROM w_golden)
               WHERE id <= CASE difficulty WHEN 'hard' THEN 10 ELSE 20 END"""
        ),
    ),
    "generation_prompts": Entry(
        lambda s, d: dataset.generation_prompts(_sample(s, d), F.lit("Table: EVENTS")),
        _sql(
            """SELECT difficulty, batch, wanted, concat('Write business questions about this warehouse, each with one SQL query.',
                      chr(10), chr(10), 'SCHEMA:', chr(10), 'Table: EVENTS', chr(10), chr(10), 'DIFFICULTY: ', difficulty, ' (',
                      CASE difficulty
                          WHEN 'easy' THEN 'answerable from a single table'
                          WHEN 'medium' THEN 'needs tables to be combined and grouped'
                          ELSE 'needs several steps, such as a ranking inside groups' END,
                      ')', chr(10), 'NUMBER: ', wanted, chr(10), chr(10), 'Answer with a JSON array of ', wanted,
                      ' objects: question, sql_query, tables_used. Prefix tables with their schema; do not repeat a pattern.') AS prompt
               FROM (SELECT difficulty, (id - 1) // 5 AS batch, COUNT(*) AS wanted
                     FROM (SELECT difficulty, ROW_NUMBER() OVER (
                               PARTITION BY difficulty ORDER BY md5('42:' || position), position) AS id FROM w_golden)
                     WHERE id <= CASE difficulty WHEN 'hard' THEN 10 ELSE 20 END
                     GROUP BY 1, 2)"""
        ),
    ),
    "describe_prompts": Entry(
        lambda s, d: dataset.describe_prompts(
            table(s, d, "documents").select(
                F.col("source").alias("table_name"),
                F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("column_name"),
                F.lit("VARCHAR").alias("data_type"),
            ),
            page_columns=20,
        ),
        """SELECT source AS table_name, page, concat('Describe each column of this table for business users.', chr(10), chr(10),
                  'Table: ', source, chr(10), 'Columns:', chr(10), string_agg(concat('- ', name, ' (VARCHAR)'), chr(10) ORDER BY rn),
                  chr(10), chr(10),
                  'Answer with a JSON array of objects: column_name, description, synonyms, sample_values.') AS prompt
           FROM (SELECT source, name, rn, (rn - 1) // 20 AS page FROM (
               SELECT source, concat('doc_', doc_id) AS name,
                      ROW_NUMBER() OVER (PARTITION BY source ORDER BY concat('doc_', doc_id)) AS rn FROM documents))
           GROUP BY source, page""",
    ),
    "ids_per_difficulty": Entry(
        lambda s, d: number_rows_per_group(
            _golden(s, d).select("position", "difficulty"), "difficulty", ["position"], "id"
        ),
        _sql(
            """SELECT position, difficulty, ROW_NUMBER() OVER (PARTITION BY difficulty ORDER BY position) AS id
               FROM w_golden"""
        ),
    ),
}


def _sales_per_customer(spark, sf_dir) -> DataFrame:
    star = Star(spark, sf_dir)
    counts = star.orders.groupBy("customer_id").agg(F.count("*").alias("order_count"))
    named = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), "c_acctbal"
    )
    return named.join(counts, "customer_id")


PRESENTATION: dict[str, Entry] = {
    "chart_bars": Entry(
        lambda s, d: presentation.chart_frame(_sales_per_customer(s, d)),
        """SELECT c_name AS x, n AS y, 1::BIGINT AS points, 'bar' AS kind, 'order_count by customer_name' AS title, true AS horizontal
           FROM customer JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey
           ORDER BY n DESC, c_name LIMIT 500""",
    ),
    "chart_few_bars": Entry(
        lambda s, d: presentation.chart_frame(orders.orders_by_status(Star(s, d))),
        with_ctes(
            """SELECT status AS x, COUNT(*) AS y, 1::BIGINT AS points, 'bar' AS kind, 'order_count by status' AS title, false AS horizontal
               FROM w_orders GROUP BY status""",
            ROLES,
        ),
    ),
    "chart_line": Entry(
        lambda s, d: presentation.chart_frame(orders.monthly_order_growth(Star(s, d))),
        with_ctes(
            """SELECT DATE_TRUNC('month', purchase_ts) AS x, CAST(COUNT(*) AS DOUBLE) AS y, COUNT(*) AS low, COUNT(*) AS high,
                      COUNT(*) AS first, COUNT(*) AS last, 1::BIGINT AS points, 'line' AS kind,
                      'total_orders over month' AS title, false AS horizontal
               FROM w_orders GROUP BY 1""",
            ROLES,
        ),
    ),
    "chart_scatter": Entry(
        lambda s, d: presentation.chart_frame(table(s, d, "part").select("p_size", "p_retailprice")),
        """SELECT CAST(min(p_size) AS DOUBLE) AS x, min(p_retailprice) AS y, COUNT(*) AS points, 'scatter' AS kind,
                  'p_retailprice vs p_size' AS title, false AS horizontal
           FROM (SELECT p_size, p_retailprice,
                        least(floor((p_size - min(p_size) OVER ()) / CAST(max(p_size) OVER () - min(p_size) OVER () AS DOUBLE) * 22), 21) AS i,
                        least(floor((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()) * 22), 21) AS j
                 FROM part)
           GROUP BY i, j""",
    ),
    "display_cap": Entry(
        lambda s, d: presentation.display_frame(
            table(s, d, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], rows=1000
        ),
        """SELECT o_orderkey, o_orderstatus, (SELECT COUNT(*) FROM orders) AS total_rows FROM orders
           ORDER BY o_orderkey LIMIT 1000""",
    ),
}

ENTRIES: dict[str, Entry] = {**EVALUATION, **MONITORING, **DATASET, **PRESENTATION}
