"""Named queries of the engine and the SQL that must give the same rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepledger.domain import DEFAULT, SUBSCORES
from stepledger.functions import jsontext, schema, text
from stepledger.operators import audit, compare, curate, rejects, reward, score, verify
from stepledger.plans import bridge as B
from stepledger.sources import documents

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores: a scan of a few small files has fewer tasks than that, and grading is costly per row."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.outputs(spread(table(spark, sf_dir, "events").select("event_id", "user_id", "ts")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step with its verdict."""
    return step_verify(spark, sf_dir)


OUT = B.outputs_sql()
SUBS = ", ".join(f'"{s}"' if s == "schema" else s for s in SUBSCORES)


@query(f"SELECT event_id, passed, {SUBS}, new_state FROM {B.judged_sql(OUT)}")
def step_verify(spark, sf_dir):
    """one step against state, schema and expectation."""
    return verify.verify_steps(steps(spark, sf_dir)).select("event_id", "result.passed", *[f"result.{s}" for s in SUBSCORES], "result.new_state")


@query(f"SELECT event_id, passed, transition_valid, new_state FROM {B.judged_sql(OUT, infer=True)}")
def step_infer(spark, sf_dir):
    """Triggers inferred from the call."""
    out = verify.verify_steps(steps(spark, sf_dir), infer=True, trigger="")
    return out.select("event_id", "result.passed", "result.transition_valid", "result.new_state")


@query(f"SELECT event_id, wrapped AS has_thought, CASE WHEN wrapped THEN thinking END AS thinking, CASE WHEN wrapped THEN tail END AS call FROM {B.facts_sql(OUT)}")
def parse_split(spark, sf_dir):
    """Thought and call of an output."""
    o = F.col("output")
    return steps(spark, sf_dir).select("event_id", text.has_thought(o).alias("has_thought"), text.thought(o).alias("thinking"), text.call_text(o).alias("call"))


@query(f"""SELECT event_id, CASE WHEN NOT wrapped THEN 'no_think' WHEN NOT js_ok THEN 'bad_json' WHEN NOT json_exists(js, '$.params') THEN 'missing_keys'
  WHEN NOT parsed THEN 'bad_version' WHEN method IS NULL THEN 'unknown_method' ELSE 'fine' END AS problem FROM {B.facts_sql(OUT)}""")
def envelope_check(spark, sf_dir):
    """What is wrong with the call before its parameters."""
    facts = F.get(verify.stateless(F.array("output")), 0)
    return steps(spark, sf_dir).select("event_id", F.coalesce(facts["problem"], F.lit("fine")).alias("problem"))


@query(f"SELECT event_id, parsed AND method IS NOT NULL AND schema_ok AS schema_ok FROM {B.facts_sql(OUT)}")
def params_schema(spark, sf_dir):
    """P5: parameters against their method's schema, natively."""
    facts = F.get(verify.stateless(F.array("output")), 0)
    return steps(spark, sf_dir).select("event_id", facts["schema_ok"].alias("schema_ok"))


@query("""SELECT event_id, json_type(props) = 'OBJECT' AND coalesce(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AND CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 10 AND 80, false) AS valid FROM events""")
def json_schema(spark, sf_dir):
    """2.10: texts against a general JSON schema."""
    rule = {"type": "object", "required": ["k"], "properties": {"k": {"allOf": [{"type": "integer"}, {"minimum": 10}, {"maximum": 80}]}}}
    return table(spark, sf_dir, "events").select("event_id", schema.validate(F.col("props"), rule).alias("valid"))


@query("SELECT event_id, json_valid(props) AS ok, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark, sf_dir):
    """Strict JSON and a field of it."""
    p = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", jsontext.valid(p).alias("ok"), F.from_json(p, "k string")["k"].alias("k"))


def _weights(name: str) -> str:
    return " + ".join(f'CAST({w} AS DOUBLE) * "{s}"' for s, w in DEFAULT.preset(name).items())


@query("SELECT event_id, " + ", ".join(f"round({_weights(p)}, 6) AS {p}" for p in DEFAULT.presets) + f" FROM {B.judged_sql(OUT)}")
def step_rewards(spark, sf_dir):
    """Rewards by each preset."""
    rows = verify.verify_steps(steps(spark, sf_dir))
    return rows.select("event_id", *[F.round(reward.step_reward(F.col("result"), w), 6).alias(p) for p, w in DEFAULT.presets.items()])


@query(f"SELECT event_id, round({_weights('shaped')}, 6) AS reward FROM {B.judged_sql(OUT, infer=True)}")
def rollout_rewards(spark, sf_dir):
    """Rewards of what was called."""
    return reward.rollout_reward(steps(spark, sf_dir)).select("event_id", F.round("reward", 6).alias("reward"))


def judged_records(spark, sf_dir) -> DataFrame:
    return verify.verify_records(B.records(table(spark, sf_dir, "events")))


FOLD = B.folded_sql()
FIRST = "CASE WHEN parse < 1 THEN 'parse' WHEN \"schema\" < 1 THEN 'schema' WHEN method_known < 1 THEN 'method_known' WHEN precondition_met < 1 THEN 'precondition_met' WHEN transition_valid < 1 THEN 'transition_valid' END"
FIRST_STEPS = f"""firsts AS (
  SELECT g.trajectory_id, g.row_idx, g.initial_state, g.passed, r.pos, r.mode
  FROM graded g LEFT JOIN (
    SELECT trajectory_id, min(pos) AS pos, arg_min(mode, pos) AS mode
    FROM (SELECT *, {FIRST} AS mode FROM results) WHERE mode IS NOT NULL GROUP BY trajectory_id
  ) r ON r.trajectory_id = g.trajectory_id AND NOT g.passed
)"""


@query(FOLD + "SELECT trajectory_id, passed, final_state, CAST(n_steps AS BIGINT) AS n_steps, CAST(first_failed - 1 AS BIGINT) AS first_failed FROM graded")
def record_fold(spark, sf_dir):
    """records folded through their states."""
    r = F.col("result")
    failed = F.filter(F.transform(r["steps"], lambda s, i: F.when(~s["passed"], i)), lambda x: x.isNotNull())
    return judged_records(spark, sf_dir).select("trajectory_id", r["passed"].alias("passed"), r["final_state"].alias("final_state"), F.size(r["steps"]).cast("long").alias("n_steps"), F.get(failed, 0).cast("long").alias("first_failed"))


@query(FOLD + f"SELECT trajectory_id, round(avg(w), 6) AS mean, round(min(w), 6) AS least, round(product(w), 6) AS product FROM (SELECT trajectory_id, {_weights('shaped')} AS w FROM results) GROUP BY trajectory_id")
def record_rewards(spark, sf_dir):
    """Rewards of records."""
    s = F.col("result.steps")
    w = DEFAULT.preset("shaped")
    return judged_records(spark, sf_dir).select("trajectory_id", *[F.round(reward.record_reward(s, w, a), 6).alias(n) for a, n in (("mean", "mean"), ("min", "least"), ("product", "product"))])


@query(FOLD + f", {FIRST_STEPS} SELECT mode AS subscore, count(*) AS n, min(row_idx) AS first_row FROM firsts WHERE mode IS NOT NULL GROUP BY mode")
def failure_modes(spark, sf_dir):
    """A4: what failed first, counted."""
    return score.failure_modes(judged_records(spark, sf_dir))


@query(FOLD + f", {FIRST_STEPS} SELECT row_idx, trajectory_id, initial_state, passed, CAST(pos - 1 AS BIGINT) AS first_failing_step, mode AS first_failing_subscore FROM firsts")
def record_diagnostics(spark, sf_dir):
    """A5: the first failure of each record."""
    out = score.diagnostics(judged_records(spark, sf_dir)).drop("error_message")
    return out.withColumn("first_failing_step", F.col("first_failing_step").cast("long"))


@query(FOLD + "SELECT coalesce(nullif(initial_state, ''), '(unknown)') AS initial_state, count(*) AS n, min(row_idx) AS first_row FROM graded WHERE NOT passed GROUP BY 1")
def failed_by_state(spark, sf_dir):
    """Failed records by initial state."""
    return score.failed_by_state(score.diagnostics(judged_records(spark, sf_dir)))


SAMPLES = B.outputs_sql(B.SAMPLE_SID, ("event_id",))
SAMPLED = f"""WITH samples AS (
  SELECT CAST(floor(event_id / 5) AS BIGINT) AS g, event_id % 5 AS sample_idx, passed, regexp_replace(output, '^\\s*<think>.*?</think>\\s*', '', 's') AS vote
  FROM {B.judged_sql(SAMPLES)}
), votes AS (
  SELECT g, vote, count(*) AS n, min(sample_idx) AS first, bool_or(passed) AS won FROM samples WHERE sample_idx > 0 GROUP BY g, vote
), winners AS (
  SELECT g, won AS maj FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, first) AS rn FROM votes) WHERE rn = 1
), each_ AS (
  SELECT g, bool_or(passed) FILTER (sample_idx = 0) AS p1, coalesce(bool_or(passed) FILTER (sample_idx > 0), false) AS pk, count(*) FILTER (sample_idx > 0) AS k
  FROM samples GROUP BY g
)
"""


def sampled(spark, sf_dir) -> DataFrame:
    """Records of one step with a greedy output and four samples."""
    rows = B.outputs(spread(table(spark, sf_dir, "events").select("event_id")), B.SAMPLE_SID, ("event_id",))
    step = F.array(F.struct("expected_trigger", "expected_state_after"))
    shaped = rows.select(F.floor(F.col("event_id") / 5).alias("trajectory_id"), (F.col("event_id") % 5).alias("sample_idx"), F.col("prior_state").alias("initial_state"), F.lit(None).cast("string").alias("final_state"), step.alias("steps"), F.array("output").alias("outputs"), F.col("output").alias("final_call"))
    return verify.verify_records(shaped)


@query(SAMPLED + "SELECT count(*) AS n_examples, round(avg(CAST(p1 AS DOUBLE)), 6) AS pass_at_1, round(avg(CAST(pk AS DOUBLE)), 6) AS pass_at_k, round(avg(CAST(coalesce(maj, false) AS DOUBLE)), 6) AS pass_at_maj, max(k) AS k FROM each_ LEFT JOIN winners USING (g)")
def pass_rates(spark, sf_dir):
    """A1-A3: pass@1, pass@k and majority vote."""
    out = score.run_scores(sampled(spark, sf_dir))
    return out.select("n_examples", *[F.round(m, 6).alias(m) for m in compare.METRICS], "k")


@query(SAMPLED + "SELECT g AS trajectory_id, maj FROM winners")
def majority_vote(spark, sf_dir):
    """A3: the vote on each record, the first seen of equal calls winning."""
    return score.majority(sampled(spark, sf_dir).where("sample_idx > 0"))


RUNS = """runs AS (
  SELECT 'arm' || CAST(d.doc_id % 3 AS VARCHAR) || '-seed' || CAST(CAST(floor(d.doc_id / 3) AS BIGINT) % (3 + d.doc_id % 3) AS VARCHAR) AS run_name, count(*) AS n_examples,
         avg(CAST(l.quality AS DOUBLE)) AS pass_at_1, avg(CAST(l.toxic AS DOUBLE)) AS pass_at_k, avg(CAST(l.quality * l.toxic AS DOUBLE)) AS pass_at_maj
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1
)"""


def runs(spark, sf_dir) -> DataFrame:
    d, q = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    arm = F.concat(F.lit("arm"), (F.col("doc_id") % 3).cast("string"), F.lit("-seed"), (F.floor(F.col("doc_id") / 3) % (3 + F.col("doc_id") % 3)).cast("string"))
    rows = d.join(q, "doc_id").groupBy(arm.alias("run_name"))
    return rows.agg(F.count("*").alias("n_examples"), F.avg(F.col("quality").cast("double")).alias("pass_at_1"), F.avg(F.col("toxic").cast("double")).alias("pass_at_k"), F.avg((F.col("quality") * F.col("toxic")).cast("double")).alias("pass_at_maj"))


@query(f"WITH {RUNS}" + """ SELECT run_name, n_examples, round(pass_at_1, 6) AS pass_at_1, CASE WHEN run_name = 'arm0-seed0' THEN NULL ELSE round(pass_at_1 - b, 6) END AS delta,
  CASE WHEN run_name = 'arm0-seed0' THEN '(base)' ELSE 'number' END AS delta_kind, run_name <> 'arm0-seed0' AND pass_at_1 - b < 0 AS worse
  FROM runs, (SELECT pass_at_1 AS b FROM runs WHERE run_name = 'arm0-seed0')""")
def run_table(spark, sf_dir):
    """Runs against a baseline."""
    out = compare.run_table(runs(spark, sf_dir).withColumn("file", F.col("run_name")), "arm0-seed0")
    return out.select("run_name", "n_examples", F.round("pass_at_1", 6).alias("pass_at_1"), F.round("delta", 6).alias("delta"), "delta_kind", "worse")


def _arm(m: str) -> str:
    q1 = f"(v[least(greatest((len(v) + 1) // 4, 1), len(v) - 1)] * (4 - ((len(v) + 1) - 4 * least(greatest((len(v) + 1) // 4, 1), len(v) - 1))) + v[least(greatest((len(v) + 1) // 4, 1), len(v) - 1) + 1] * ((len(v) + 1) - 4 * least(greatest((len(v) + 1) // 4, 1), len(v) - 1))) / 4"
    q3 = q1.replace("(len(v) + 1)", "(3 * (len(v) + 1))")
    return f"round(median({m}), 6) AS {m}_median, round(CASE WHEN count({m}) >= 4 THEN (({q3}) - ({q1})) / 2 ELSE 0 END, 6) AS {m}_half_iqr".replace("v[", f"list({m} ORDER BY {m})[").replace("len(v)", f"count({m})")


@query(f"WITH {RUNS} SELECT regexp_extract(run_name, '^(.+)-seed(\\d+)$', 1) AS family, count(*) AS n_seeds, " + ", ".join(map(_arm, compare.METRICS)) + " FROM runs GROUP BY 1")
def arm_summary(spark, sf_dir):
    """Medians and exclusive quartiles over seeds."""
    out = compare.arm_summary(runs(spark, sf_dir))
    return out.select("family", "n_seeds", *[F.round(f"{m}_{k}", 6).alias(f"{m}_{k}") for m in compare.METRICS for k in ("median", "half_iqr")])


@query(f"""WITH modes AS (SELECT {FIRST} AS subscore FROM {B.judged_sql(OUT)} WHERE NOT passed), counts AS (SELECT subscore, count(*) AS n FROM modes GROUP BY 1),
names AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, '{s}')" for i, s in enumerate(SUBSCORES)) + """) t(place, subscore))
SELECT place, names.subscore, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) = 0 THEN 0 ELSE greatest(1, CAST(round_even(20.0 * n / (SELECT max(n) FROM counts), 0) AS INTEGER)) END AS bar
FROM names LEFT JOIN counts ON names.subscore = counts.subscore""")
def failure_chart(spark, sf_dir):
    """Failures by subscore with bar lengths."""
    rows = verify.verify_steps(steps(spark, sf_dir)).where("NOT result.passed")
    return compare.failure_chart(rows.groupBy(verify.first_failing(F.col("result")).alias("subscore")).agg(F.count("*").alias("n")))


@query("""SELECT lang, (SELECT string_agg(s || '(' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY n DESC, s) FROM (SELECT source AS s, count(*) AS n FROM documents x WHERE x.lang IS NOT DISTINCT FROM d.lang GROUP BY source ORDER BY n DESC, s LIMIT 3)) AS top
FROM (SELECT DISTINCT lang FROM documents) d""")
def top_failures(spark, sf_dir):
    """The three most frequent names of a map, those as frequent in its order."""
    counts = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    maps = counts.groupBy("lang").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("m"))
    return maps.select("lang", compare.top_failures(F.col("m")).alias("top"))


@query("SELECT count(*) AS n FROM (SELECT text FROM documents WHERE doc_id % 2 = 0 INTERSECT SELECT text FROM documents WHERE doc_id % 2 = 1)")
def overlap_exact(spark, sf_dir):
    """Equal contents of two sides."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return audit.exact_overlap(d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1")).agg(F.count("*").alias("n"))


@query("SELECT CAST(user_id AS VARCHAR) AS origin FROM events INTERSECT SELECT CAST(c_custkey AS VARCHAR) FROM customer")
def overlap_origins(spark, sf_dir):
    """Origins that two sides share."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("trajectory_id"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("trajectory_id"))
    return audit.shared_origins(e, c)


WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> ''))"


@query(f"""WITH d AS (SELECT doc_id, {WORDS} AS t FROM documents),
tokens AS (SELECT doc_id, len(t) AS n, unnest(t) AS w FROM d),
sides AS (SELECT l.doc_id AS left_id, r.doc_id AS right_id, any_value(l.n) AS ln, any_value(r.n) AS rn, count(*) AS shared
  FROM tokens l JOIN tokens r ON l.w = r.w WHERE l.doc_id % 2 = 0 AND r.doc_id % 2 = 1 AND l.n >= 0.8 * r.n - 1e-9 AND r.n >= 0.8 * l.n - 1e-9 GROUP BY 1, 2)
SELECT left_id, right_id, round(shared / (ln + rn - shared), 6) AS similarity FROM sides WHERE shared / (ln + rn - shared) >= 0.8""")
def overlap_similar(spark, sf_dir):
    """Pairs with similar token sets."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return audit.similar_pairs(d.where("id % 2 = 0"), d.where("id % 2 = 1")).select("left_id", "right_id", F.round("similarity", 6).alias("similarity"))


def rejected(spark, sf_dir) -> DataFrame:
    rows = verify.verify_steps(steps(spark, sf_dir)).where("NOT result.passed")
    return rows.select(F.col("event_id").alias("row_idx"), F.col("user_id").cast("string").alias("seed_id"), F.col("result.error_class").alias("reason"), F.col("output").alias("error"))


REASON = f"""rejected AS (SELECT event_id AS row_idx, CAST(user_id AS VARCHAR) AS seed_id, output AS error,
 CASE WHEN NOT wrapped THEN 'no_think' WHEN NOT js_ok THEN 'bad_json' WHEN NOT json_exists(js, '$.params') THEN 'missing_keys' WHEN NOT parsed THEN 'bad_version'
  WHEN method IS NULL THEN 'unknown_method' WHEN NOT schema_ok THEN 'schema' ELSE 'transition' END AS reason FROM {B.judged_sql(OUT)} WHERE NOT passed)"""


@query(f"WITH {REASON} SELECT reason, count(*) AS n, min(row_idx) AS first_row FROM rejected GROUP BY 1")
def rejects_by_reason(spark, sf_dir):
    """Rejections by reason."""
    return rejects.by_reason(rejected(spark, sf_dir))


@query(f"WITH {REASON} SELECT seed_id, count(*) AS n, min(row_idx) AS first_row FROM rejected GROUP BY 1 ORDER BY n DESC, first_row LIMIT 20")
def rejects_by_seed(spark, sf_dir):
    """The seeds that are rejected most."""
    return rejects.top(rejects.by_seed(rejected(spark, sf_dir)), rejects.TOP_SEEDS)


@query(f"WITH {REASON} SELECT trim(substr(error, 1, 80)) AS error, count(*) AS n, min(row_idx) AS first_row FROM rejected GROUP BY 1 ORDER BY n DESC, first_row LIMIT 10")
def rejects_by_error(spark, sf_dir):
    """The most frequent beginnings of errors."""
    return rejects.top(rejects.by_error(rejected(spark, sf_dir)), rejects.TOP_ERRORS)


@query(f"SELECT event_id, regexp_replace(output, '^\\s*<think>.*?</think>\\s*', '', 's') AS call FROM {OUT}")
def canonical_call(spark, sf_dir):
    """Calls as they are compared in a vote."""
    return steps(spark, sf_dir).select("event_id", text.without_thought(F.col("output")).alias("call"))


@query(f"SELECT event_id, trim(output) AS bare FROM {OUT}")
def strip_fences(spark, sf_dir):
    """Outputs out of the code fences that every other one has."""
    o = F.col("output")
    fenced = F.when(F.col("event_id") % 2 == 0, o).otherwise(F.concat(F.lit(" ```json\n"), o, F.lit("\n```\n")))
    return steps(spark, sf_dir).select("event_id", text.without_fences(fenced).alias("bare"))


@query(f"SELECT event_id, output AS content FROM {OUT}")
def response_content(spark, sf_dir):
    """Texts of responses of three shapes."""
    o = F.col("output")
    body = (
        F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.array(F.struct(F.struct(o.alias("content")).alias("message"))).alias("choices"))))
        .when(F.col("event_id") % 3 == 1, F.to_json(F.struct(F.array(F.struct(o.alias("text"))).alias("choices"))))
        .otherwise(F.to_json(F.struct(F.array(F.struct(F.lit("text").alias("type"), F.left(o, F.lit(20)).alias("text")), F.struct(F.lit("text").alias("type"), F.substr(o, F.lit(21)).alias("text"))).alias("content"))))
    )
    return steps(spark, sf_dir).select("event_id", text.response_content(body).alias("content"))


TALK = "SELECT conv_id, list(struct_pack(turn := turn, role := role, text := text) ORDER BY turn) AS s FROM conversations GROUP BY conv_id"


def talks(spark, sf_dir) -> DataFrame:
    """Conversations as records whose steps call with the digest of their text."""
    c = table(spark, sf_dir, "conversations").withColumn("call", F.concat(F.lit('"'), F.md5("text"), F.lit('"')))
    step = F.struct("turn", F.col("role").alias("prior_state"), F.lit(None).cast("string").alias("situation"), F.lit(None).cast("string").alias("prior_calls"), F.md5("role").alias("thinking"), F.col("call").alias("tool_call"))
    return c.groupBy(F.col("conv_id").alias("trajectory_id")).agg(F.array_sort(F.collect_list(step)).alias("steps"))


@query("""SELECT conv_id AS trajectory_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS step_idx,
  '["' || string_agg(md5(text), '", "') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) || '"]' AS prior_calls FROM conversations""")
def prior_calls(spark, sf_dir):
    """The calls before each step."""
    rows = talks(spark, sf_dir).select("trajectory_id", F.posexplode(curate.prior_calls(F.col("steps"))).alias("step_idx", "s"))
    return rows.select("trajectory_id", "step_idx", F.col("s.prior_calls").alias("prior_calls"))


@query("""SELECT conv_id AS trajectory_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS step_idx, 'Prior state: ' || role AS asked,
  '<think>' || md5(role) || '</think>"' || md5(text) || '"' AS answered FROM conversations""")
def chat_messages(spark, sf_dir):
    """A chat sample for each step."""
    m = F.col("messages")
    return curate.step_samples(talks(spark, sf_dir)).select("trajectory_id", "step_idx", m[1]["content"].alias("asked"), m[2]["content"].alias("answered"))


@query("""SELECT doc_id, CASE WHEN place < floor(n * 0.8 + 1e-9) THEN 'train' WHEN place < floor(n * 0.8 + 1e-9) + floor(n * 0.1 + 1e-9) THEN 'dev' ELSE 'rest' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place, count(*) OVER () AS n FROM documents)""")
def split_rows(spark, sf_dir):
    """Train, dev and the rest in a fixed random order."""
    return curate.split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", seed=7).select("doc_id", "split")


@query("""SELECT doc_id AS row_idx, CASE WHEN nth > 0 THEN lang || '_' || CAST(nth AS VARCHAR) ELSE lang END AS trajectory_id
FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS nth FROM documents)""")
def unique_ids(spark, sf_dir):
    """Repeated ids with suffixes."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"), F.col("lang").alias("trajectory_id"))
    return curate.unique_ids(d).select("row_idx", "trajectory_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_remaining(spark, sf_dir):
    """Rows that are still to do."""
    return curate.remaining(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS mean_value FROM events")
def rolling_mean(spark, sf_dir):
    """Means over the last ten rows."""
    out = score.rolling_means(table(spark, sf_dir, "events"), ["value"], ["ts", "event_id"], F.to_date("ts"), ["user_id"], 10)
    return out.select("event_id", F.round("mean_value", 6).alias("mean_value"))


@query("SELECT doc_id, sha256(text) AS system_prompt_sha256, '2024-05-06T07:08:09.000000Z' AS expansion_timestamp_utc, lang AS seed_trajectory_id FROM documents")
def provenance(spark, sf_dir):
    """Rows stamped with their origin."""
    out = curate.provenance(table(spark, sf_dir, "documents"), F.col("text"), "2024-05-06 07:08:09", seed_trajectory_id=F.col("lang"))
    return out.select("doc_id", "provenance.system_prompt_sha256", "provenance.expansion_timestamp_utc", "provenance.seed_trajectory_id")


@query("SELECT 'region=' || url_encode(r.r_name) || ',nation.name=' || url_encode(n.n_name) AS slug, r_name AS region, n_name AS nation FROM region r, nation n")
def sweep_grid(spark, sf_dir):
    """All choices of two axes, both of fixed size."""
    names = {k: [r[0] for r in table(spark, sf_dir, t).select(c).orderBy(c).collect()] for k, t, c in (("region", "region", "r_name"), ("nation.name", "nation", "n_name"))}
    rows = [(slug, config["region"], config["nation"]["name"]) for slug, config in documents.sweep({"base": "base.yaml", "axes": names})]
    return spark.createDataFrame(rows, "slug string, region string, nation string")


@query("SELECT DISTINCT lang AS name FROM documents WHERE lang IS NOT NULL")
def distinct_names(spark, sf_dir):
    """D3: distinct names."""
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("name")).where("name IS NOT NULL").distinct()


@query(f"SELECT CASE WHEN user_id % 2 = 0 THEN 'train' ELSE 'dev' END AS split, count(*) AS total, count(*) FILTER (passed) AS ok, count(*) FILTER (NOT passed) AS failed FROM {B.judged_sql(OUT)} GROUP BY 1")
def verify_totals(spark, sf_dir):
    """Totals by split."""
    rows = verify.verify_steps(steps(spark, sf_dir)).select(F.when(F.col("user_id") % 2 == 0, "train").otherwise("dev").alias("split"), "result.passed")
    return curate.totals(rows)


def _ways() -> str:
    """Methods and states with the first states that the method's triggers lead to, as rows."""
    rows = []
    for m in DEFAULT.methods:
        for at in DEFAULT.states:
            ends = [DEFAULT.arcs[at, t] for t in DEFAULT.triggers[m] if (at, t) in DEFAULT.arcs]
            rows.append(f"('{m}', '{at}', '{', '.join(ends)}')")
    return "(VALUES " + ", ".join(rows) + ") AS ways(w_method, w_state, ends)"


CLASS = """CASE WHEN NOT wrapped THEN 'no_think' WHEN NOT js_ok THEN 'bad_json' WHEN NOT json_exists(js, '$.params') THEN 'missing_keys' WHEN NOT parsed THEN 'bad_version'
  WHEN method IS NULL THEN 'unknown_method' WHEN NOT schema_ok THEN 'schema' WHEN NOT moved THEN 'transition' END"""
MESSAGE = f"""CASE {CLASS} WHEN 'no_think' THEN 'no thought in its tags before the call' WHEN 'bad_json' THEN 'the call is not strict JSON' WHEN 'missing_keys' THEN 'the call lacks one of its four keys'
  WHEN 'bad_version' THEN 'jsonrpc is not ' || chr(39) || '2.0' || chr(39) WHEN 'unknown_method' THEN 'unknown method: ' || json_extract_string(js, '$.method') WHEN 'schema' THEN 'parameters of ' || method || ' break their schema' WHEN 'transition' THEN """


@query(f"SELECT event_id, {CLASS} AS error_class, {MESSAGE} 'transition_valid=0: ' || method || ' from ' || prior_state || ' with trigger ' || coalesce(expected_trigger, 'none') || ' and expected state ' || coalesce(expected_state_after, 'any') END AS error_message FROM {B.judged_sql(OUT)}")
def step_errors(spark, sf_dir):
    """What is wrong with each step, in words."""
    return verify.verify_steps(steps(spark, sf_dir)).select("event_id", "result.error_class", "result.error_message")


@query(f"SELECT event_id, {MESSAGE} CASE WHEN ends = '' THEN 'transition_valid=0: no trigger of ' || method || ' has an arc from ' || prior_state ELSE 'transition_valid=0: ' || method || ' from ' || prior_state || ' leads to ' || ends || ' and not to ' || expected_state_after END END AS error_message FROM {B.judged_sql(OUT, infer=True)} LEFT JOIN {_ways()} ON w_method = method AND w_state = prior_state")
def infer_errors(spark, sf_dir):
    """The messages where triggers are inferred."""
    return verify.verify_steps(steps(spark, sf_dir), infer=True, trigger="").select("event_id", "result.error_message")


@query(f"SELECT event_id, parsed AND method IS NOT NULL AND schema_ok AND (method <> 'ticket_open' OR json_extract_string(js, '$.params.body_text') LIKE 'text 1%') AS schema_ok FROM {B.facts_sql(OUT)}")
def loaded_domain(spark, sf_dir):
    """Parameters against the schemas of another domain, with references, choices and patterns."""
    opened = {**DEFAULT.params["ticket_open"], "allOf": [{"properties": {"body_text": {"pattern": "^text 1"}}}, {"properties": {"lifecycle_profile": {"enum": ["std", "long"]}}}]}
    asked = {"$ref": "#/$defs/ticket", "unevaluatedProperties": False}
    domain = replace(DEFAULT, params={**DEFAULT.params, "ticket_open": opened, "ticket_get": asked}, defs={"ticket": {"type": "object", "required": ["ticket_id"], "properties": {"ticket_id": {"type": "string", "minLength": 1}}}})
    facts = F.get(verify.stateless(F.array("output"), domain), 0)
    return steps(spark, sf_dir).select("event_id", facts["schema_ok"].alias("schema_ok"))


@query(FOLD + "SELECT trajectory_id, passed, CAST(coalesce(first_failed, n_steps) AS BIGINT) AS n_steps FROM graded")
def record_stop(spark, sf_dir):
    """records folded up to their first failure."""
    out = verify.verify_records(B.records(table(spark, sf_dir, "events")), stop_at_failure=True)
    return out.select("trajectory_id", F.col("result.passed").alias("passed"), F.size("result.steps").cast("long").alias("n_steps"))


def saved(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Records of one step, and the responses of those whose output has a thought; the others lack their files."""
    rows = steps(spark, sf_dir).withColumn("trajectory_id", F.col("event_id").cast("string"))
    step = F.array(F.struct("prior_state", "expected_trigger", "expected_state_after"))
    records = rows.select("trajectory_id", F.col("prior_state").alias("initial_state"), F.lit(None).cast("string").alias("final_state"), step.alias("steps"))
    o = F.col("output")
    kept = rows.where(text.has_thought(o)).select("trajectory_id", F.lit(0).alias("step_idx"), text.thought(o).alias("think"), text.call_text(o).alias("call"))
    return records, kept


@query(f"SELECT CAST(event_id AS VARCHAR) AS trajectory_id, passed, CAST(CASE WHEN wrapped THEN 0 ELSE 2 END AS BIGINT) AS missing, parse FROM {B.judged_sql(OUT)}")
def saved_scores(spark, sf_dir):
    """Records graded by saved responses; a missing file is a parse failure."""
    out = score.saved_scores(*saved(spark, sf_dir))
    return out.select("trajectory_id", F.col("result.passed").alias("passed"), "missing", F.get("result.steps", F.lit(0))["parse"].alias("parse"))


@query(f"SELECT CAST(event_id AS VARCHAR) AS trajectory_id, passed, new_state FROM {B.judged_sql(OUT)}")
def saved_step(spark, sf_dir):
    """One step graded by its saved pair of responses."""
    return score.saved_step(*saved(spark, sf_dir), 0).select("trajectory_id", "result.passed", "result.new_state")


SPLIT = "CASE CAST(doc_id % 3 AS INTEGER) WHEN 0 THEN 'train' WHEN 1 THEN 'dev' ELSE 'test' END"


def _pair_sql(a: str, b: str) -> str:
    return f"""SELECT '{a}/{b}' AS pair, (SELECT count(*) FROM (SELECT text FROM s WHERE split = '{a}' INTERSECT SELECT text FROM s WHERE split = '{b}')) AS exact_overlap,
  (SELECT string_agg(first, ',' ORDER BY first) FROM (SELECT min(id) AS first FROM s WHERE split = '{a}' AND text IN (SELECT text FROM s WHERE split = '{b}') GROUP BY text ORDER BY first LIMIT 3)) AS exact_examples,
  (SELECT count(*) FROM pairs WHERE ls = '{a}' AND rs = '{b}') AS similar_pairs,
  (SELECT string_agg(l || '~' || r, ',' ORDER BY l, r) FROM (SELECT l, r FROM pairs WHERE ls = '{a}' AND rs = '{b}' ORDER BY l, r LIMIT 3)) AS examples"""


@query(f"""WITH s AS (SELECT CAST(doc_id AS VARCHAR) AS id, text, {SPLIT} AS split, {WORDS} AS t FROM documents), tokens AS (SELECT id, split, len(t) AS n, unnest(t) AS w FROM s),
met AS (SELECT l.id AS l, r.id AS r, any_value(l.split) AS ls, any_value(r.split) AS rs, any_value(l.n) AS ln, any_value(r.n) AS rn, count(*) AS shared
  FROM tokens l JOIN tokens r ON l.w = r.w WHERE l.split <> r.split AND l.n >= 0.8 * r.n - 1e-9 AND r.n >= 0.8 * l.n - 1e-9 GROUP BY 1, 2),
pairs AS (SELECT l, r, ls, rs FROM met WHERE shared / (ln + rn - shared) >= 0.8)
""" + " UNION ALL ".join(_pair_sql(a, b) for a, b in (("train", "dev"), ("train", "test"), ("dev", "test"))))
def audit_splits(spark, sf_dir):
    """Three splits held against each other, with examples."""
    d = table(spark, sf_dir, "documents")
    record = F.to_json(F.struct(F.col("text"), F.lit("hand").alias("source"), F.col("doc_id").alias("provenance")))
    rows = d.select(F.col("doc_id").cast("string").alias("trajectory_id"), F.col("text").alias("situation"), record.alias("raw"), F.expr(SPLIT.replace("INTEGER", "INT")).alias("split"))
    named = F.transform("examples", lambda e: F.concat(e["left_id"], F.lit("~"), e["right_id"]))
    out = audit.audit_splits(rows)

    def listed(values) -> F.Column:
        return F.nullif(F.array_join(values, ","), F.lit(""))

    return out.select("pair", "exact_overlap", listed(F.col("exact_examples")).alias("exact_examples"), "similar_pairs", listed(named).alias("examples"))


@query("SELECT event_id, sha256('{\"k\": ' || json_extract_string(props, '$.k') || '}') AS digest FROM events")
def content_digests(spark, sf_dir):
    """Digests of records whatever the order of their keys and their origin."""
    k = F.from_json("props", "k bigint")["k"]
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"source": "x", "k":'), k.cast("string"), F.lit("}"))).otherwise(F.concat(F.lit('{"k":'), k.cast("string"), F.lit(',"provenance":{"a":1}}')))
    return table(spark, sf_dir, "events").select("event_id", audit.content_digest(raw).alias("digest"))


GATE = "CASE WHEN NOT wrapped THEN 'teacher_error' WHEN NOT js_ok THEN 'json_decode' WHEN coalesce(method = 'ticket_history', false) THEN 'malformed_structure' WHEN passed THEN 'accept' ELSE 'verifier_failed' END"


def completions(spark, sf_dir) -> DataFrame:
    """Outputs as a teacher's completions: fenced records of one step; histories come without their thought."""
    o, q = F.col("output"), F.to_json(F.struct("prior_state", "expected_trigger", "expected_state_after"))
    call = text.call_text(o)
    lost = call.contains('"method":"ticket_history"')
    step = F.concat(F.lit('{"prompt_context":'), q, F.when(lost, F.lit("")).otherwise(F.lit(',"thinking":"t"')), F.lit(',"expected_trigger":'), F.coalesce(F.concat(F.lit('"'), F.col("expected_trigger"), F.lit('"')), F.lit("null")), F.lit(',"expected_state_after":'), F.coalesce(F.concat(F.lit('"'), F.col("expected_state_after"), F.lit('"')), F.lit("null")), F.lit(',"tool_call":'), call, F.lit("}"))
    record = F.concat(F.lit('```json\n{"trajectory_id":"r","initial_state":"'), F.col("prior_state"), F.lit('","steps":['), step, F.lit("]}\n```"))
    return steps(spark, sf_dir).withColumn("raw", F.when(text.has_thought(o), record)).withColumn("seed_id", F.col("user_id").cast("string")).withColumn("split", F.when(F.col("user_id") % 2 == 0, "train").otherwise("dev"))


@query(f"SELECT event_id, {GATE} AS verdict FROM {B.judged_sql(OUT)}")
def teacher_gate(spark, sf_dir):
    """What becomes of each completion."""
    return curate.gate(completions(spark, sf_dir)).select("event_id", "verdict")


@query(f"SELECT count(*) FILTER (v = 'accept') AS accepted, count(*) FILTER (v <> 'accept') AS rejected, count(*) FILTER (v = 'accept' AND user_id % 2 = 0) AS train, count(*) FILTER (v = 'accept' AND user_id % 2 = 1) AS dev, CAST(0 AS BIGINT) AS test FROM (SELECT user_id, {GATE} AS v FROM {B.judged_sql(OUT)})")
def expansion_counts(spark, sf_dir):
    """Accepted and rejected completions, and those of each split."""
    return curate.expansion_counts(curate.gate(completions(spark, sf_dir)))


@query(f"SELECT CAST(user_id AS VARCHAR) AS seed_id, count(*) AS n FROM (SELECT user_id, {GATE} AS v FROM {B.judged_sql(OUT)}) WHERE v = 'accept' GROUP BY 1")
def existing_by_seed(spark, sf_dir):
    """The accepted rows that each seed has."""
    good = curate.gate(completions(spark, sf_dir)).where("verdict = 'accept'")
    # ids of their own, for which rows are read three times, do not change how many there are
    origin = curate.teacher_provenance(F.lit("p"), "2024-05-06 07:08:09", seed_trajectory_id=F.col("seed_id"))
    return curate.existing_by_seed(good.select(origin.alias("provenance")))


FIELDS = list(curate.TEACHER_FIELDS)


@query("""SELECT doc_id, 'p' AS teacher_provider, lang AS teacher_model, NULL AS teacher_model_version, sha256(text) AS system_prompt_sha256, doc_id AS expansion_seed, 0.7 AS expansion_temperature, 'json_object' AS response_format,
 NULL AS grammar_path, '2024-05-06T07:08:09.000000Z' AS expansion_timestamp_utc, source AS seed_trajectory_id, 'hand_seed' AS seed_provider, source AS seed_seed_trajectory_id FROM documents""")
def provenance_structs(spark, sf_dir):
    """The structs of expanded rows and of seeds."""
    at = "2024-05-06 07:08:09"
    teacher = curate.teacher_provenance(F.col("text"), at, teacher_provider="p", teacher_model=F.col("lang"), expansion_seed=F.col("doc_id"), expansion_temperature=0.7, response_format="json_object", seed_trajectory_id=F.col("source"))
    out = table(spark, sf_dir, "documents").select("doc_id", teacher.alias("p"), curate.seed_provenance(at, seed_trajectory_id=F.col("source")).alias("h"))
    return out.select("doc_id", *[F.col(f"p.{k}").alias(k) for k in FIELDS if k != "engine_version"], F.col("h.teacher_provider").alias("seed_provider"), F.col("h.seed_trajectory_id").alias("seed_seed_trajectory_id"))


@query("SELECT doc_id, split FROM documents, (VALUES ('train'), ('dev'), ('test')) AS names(split)")
def identity_split(spark, sf_dir):
    """Every row in every split."""
    return curate.same_in_all(table(spark, sf_dir, "documents").select("doc_id")).select("doc_id", "split")


def _request_sql(ask: str, extra: str = "", more: str = "") -> str:
    system = curate.SYSTEM.replace("'", "''")
    return f"""'{{"model":"m","messages":[{{"role":"system","content":"{system}"}},{{"role":"user","content":"Prior state: ' || role || '"}},{extra}{{"role":"user","content":"{ask}"}}],"max_tokens":256,"temperature":0.0{more}}}'"""


@query("SELECT conv_id AS trajectory_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS step_idx, sha256(" + _request_sql(curate.ASKS[0]) + ") AS think_sha256, sha256(" + _request_sql(curate.ASKS[1], """{"role":"assistant","content":"<think>' || md5(role) || '</think>"},""", ',"grammar":"root ::= [a-z]"') + ") AS call_sha256 FROM conversations")
def request_payloads(spark, sf_dir):
    """K9: digests of the two requests of each step."""
    out = curate.requests(curate.step_samples(talks(spark, sf_dir)), "m", "root ::= [a-z]")
    return out.select("trajectory_id", "step_idx", "think_sha256", "call_sha256")


@query("""SELECT event_id, coalesce(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AND k >= 0 AND (CASE WHEN k % 2 = 0 THEN k NOT IN (10, 20) ELSE k <= 50 OR k IN (61, 71, 81) END), false) AS valid
FROM (SELECT event_id, props, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def schema_keywords(spark, sf_dir):
    """2.10: references, conditions, choices and closed objects of a general schema."""
    rule = {
        "$defs": {"n": {"$anchor": "whole", "type": ["integer", "null"], "minimum": 0}},
        "type": "object",
        "allOf": [{"properties": {"k": {"$ref": "#whole"}}}, True],
        "required": ["k"],
        "propertyNames": {"pattern": "^k$", "maxLength": 1},
        "minProperties": 1,
        "maxProperties": 1,
        "patternProperties": {"^k": {"exclusiveMaximum": 1e9}},
        "unevaluatedProperties": False,
        "dependentRequired": {"j": ["k"]},
        "if": {"properties": {"k": {"multipleOf": 2}}},
        "then": {"properties": {"k": {"not": {"enum": [10, 20.0]}}}},
        "else": {"properties": {"k": {"anyOf": [{"maximum": 50}, {"oneOf": [{"const": 61}, {"const": 71}, {"const": 81}]}]}}},
    }
    return table(spark, sf_dir, "events").select("event_id", schema.validate(F.col("props"), rule).alias("valid"))


@query("""SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) % 7 AS n, CAST(len(list_distinct([doc_id % 3, doc_id % 2, 2])) = 3 AS BOOLEAN) AS valid FROM documents""")
def array_keywords(spark, sf_dir):
    """2.10: keywords of arrays."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    rule = {"type": "array", "uniqueItems": True, "minItems": 3, "maxItems": 3, "prefixItems": [{"maximum": 2}, {"enum": [0, 1]}], "items": {"const": 2}, "contains": {"const": 2}, "minContains": 1, "unevaluatedItems": False}
    texts = F.to_json(F.array(F.col("doc_id") % 3, F.col("doc_id") % 2, F.lit(2)))
    placed = score.places(d, ["lang"], ["doc_id"], F.shiftright("doc_id", 16), "place")
    return placed.select("doc_id", ((F.col("place") + 1) % 7).alias("n"), schema.validate(texts, rule).alias("valid"))
