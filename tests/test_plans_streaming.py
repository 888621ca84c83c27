"""Driver contract, plan shape (no Python evaluation / no shuffle in the
row-wise stages), stream = batch, sinks and the corpus scan."""

import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.operators import cost as CO
from ledgerlens.operators import rules as B
from ledgerlens.plans import decisions as D
from ledgerlens.sources import tables as T
from ledgerlens.sources.fixtures import requests_orders, txn_orders
from ledgerlens.streaming import scoring as S

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    """Static physical plan (AQE off, so whole-stage codegen markers show)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "mean_final_risk_score" in df.columns


def test_every_query_has_callable_and_oracle_subset():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(sql) >= 90


def test_rule_stage_is_one_narrow_codegen_stage(spark):
    # the only exchange allowed is the round-robin spread of a single-split scan
    p = _plan(D.rule_scored(spark, SF))
    assert "hashpartitioning" not in p and "rangepartitioning" not in p
    assert "EvalPython" not in p and "*(" in p


def test_final_stage_has_only_the_join_shuffle(spark):
    p = _plan(D.final_decisions(spark, SF))
    assert "EvalPython" not in p
    assert "ArrowEvalPython" not in p


def test_cost_stage_is_narrow(spark):
    req = requests_orders(T.read_table(spark, SF, "orders"))
    p = _plan(CO.score_requests(req))
    assert "hashpartitioning" not in p and "EvalPython" not in p


def test_column_pruning_reaches_scan(spark):
    df = D.rule_scored(spark, SF).select("transaction_id", "rule_action")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "o_orderstatus" not in plan  # never read


def test_stream_equals_batch(spark):
    orders = T.read_table(spark, SF, "orders")
    batch = {r.transaction_id: (r.rule_risk_score, r.rule_action)
             for r in B.apply_rules(txn_orders(orders)).collect()}
    src = os.path.dirname(T.table_path(SF, "orders"))
    stream = (spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet").parquet(src))
    out = S.scoring_stream(txn_orders(stream)).select("transaction_id", "rule_risk_score", "rule_action")
    base = S.shared_dir(spark, "test_stream")
    S.run_available_now(out, os.path.join(base, "out"), os.path.join(base, "ckpt"))
    got = {r.transaction_id: (r.rule_risk_score, r.rule_action)
           for r in spark.read.parquet(os.path.join(base, "out")).collect()}
    assert got == batch


def test_sinks_and_corpus_scan(spark):
    d = tempfile.mkdtemp(prefix="ll-sink-", dir="/tmp")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    paths = T.write_report_set({"x": df, "y": df}, d, "rep")
    assert spark.read.parquet(paths["x"]).count() == 2
    T.write_jsonl(df.select(F.struct("id", "v").alias("doc")), os.path.join(d, "docs"))
    assert spark.read.json(os.path.join(d, "docs")).count() == 2
    corpus = os.path.join(d, "corpus")
    os.makedirs(os.path.join(corpus, "sub"))
    open(os.path.join(corpus, "a.md"), "w").write("# Policy\n\nBLOCK means stop.")
    open(os.path.join(corpus, "sub", "b.TXT"), "w").write("ALLOW means go.")
    open(os.path.join(corpus, "c.pdf"), "w").write("skip me")
    got = sorted(os.path.basename(r.source_path) for r in T.read_text_corpus(spark, [corpus]).collect())
    assert got == ["a.md", "b.TXT"]


def test_required_columns_contract(spark):
    df = spark.createDataFrame([(1,)], "transaction_id int")
    try:
        T.require_columns(df, ["transaction_id", "amount", "daily_limit"])
    except T.MissingColumnsError as e:
        assert "amount" in str(e) and "daily_limit" in str(e)
    else:
        raise AssertionError("expected MissingColumnsError")
