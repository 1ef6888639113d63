"""Stand-in views of the supplied tables in the shape the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.plans.preprocessing import Domain


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- dated history of entities: orders as versions, order lines as inspections ---

def versions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity_key"), F.to_date("o_orderdate").alias("received"),
        F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"))


def evaluations(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    found = F.col("l_returnflag") == "R"
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("handler"), F.to_date("l_shipdate").alias("started"),
        F.to_date("o_orderdate").alias("determined"),
        F.when(found, "Y").otherwise("N").alias("found"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N").alias("complaint"),
        F.when(found, F.col("l_extendedprice")).alias("amount"),
        F.col("l_orderkey").alias("line_order"), F.col("l_partkey").alias("line_part"),
        F.col("l_suppkey").alias("line_supplier"), F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").alias("line_quantity"))


EVALUATION_ORDER = ["line_order", "line_part", "line_supplier", "line_no", "line_quantity", "amount",
                    "found", "complaint"]

CODES = {"Brand#1": "brand_1", "Brand#2": "brand_2", "Brand#3": "brand_3", "Brand#4": "brand_4",
         "Brand#5": "brand_5"}
CODE_PREFIXES = {"Brand#1": "brand_1x", "Brand#2": "brand_2x"}
CATEGORIES = [*CODES.values(), *CODE_PREFIXES.values(), "others"]


def reports(spark: SparkSession, sf: str, key: str = "l_suppkey") -> DataFrame:
    lines, parts = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col(key).alias("reporter"), F.year("l_shipdate").alias("cycle"),
        F.col("p_brand").alias("code"), F.col("l_quantity").alias("tons"))


DOMAIN = Domain(
    entity_key="entity_key", entity_columns=("entity_key", "received", "seq", "priority"),
    entity_renames={"priority": "land_type"}, region_column="status", region="F",
    version_date="received", version_tiebreak=("seq",),
    evaluation_key="handler", evaluation_date="started",
    evaluation_columns=("line_order", "line_part", "line_supplier", "line_no", "line_quantity", "amount",
                        "found", "complaint", "started", "determined"),
    known_dates=("started", "determined"), violation_flag="found", complaint_flag="complaint",
    amount="amount", report_key="reporter",
    report_columns=("reporter", "cycle", "code", "tons"), report_lower=(), report_cycle="cycle",
    report_code="code", report_tons="tons", code_categories=CODES, code_prefixes=CODE_PREFIXES,
    code_default="others", panel_categories=CATEGORIES, population="people",
)


def raw_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Inputs of the preprocessing pipeline: reports are of customers here, who are facilities and block groups too."""
    lines, orders, parts = (table(spark, sf, n) for n in ("lineitem", "orders", "part"))
    of_customers = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
                    .join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("o_custkey").alias("reporter"), F.year("l_shipdate").alias("cycle"),
        F.col("p_brand").alias("code"), F.col("l_quantity").alias("tons")))
    placed = blocks(spark, sf)
    income = county_income(spark, sf)
    return {"entities": versions(spark, sf), "evaluations": evaluations(spark, sf), "reports": of_customers,
            "demographics": placed.select("state", "county", "tract").join(income, ["state", "county"], "left"),
            "link": placed.drop("population"), "census": placed.drop("zip").withColumnRenamed("population", "people"),
            "density": density(spark, sf), "facilities": table(spark, sf, "customer").select(
                F.col("c_custkey").alias("id_number"), F.col("c_nationkey").alias("zip_code"))}


# --- geography: customers as block groups, their region and segment as state and county ---

def blocks(spark: SparkSession, sf: str) -> DataFrame:
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("state"), F.col("c_mktsegment").alias("county"),
        F.col("c_custkey").alias("tract"), F.floor("c_acctbal").alias("population"),
        F.col("c_nationkey").alias("zip"))


def county_income(spark: SparkSession, sf: str) -> DataFrame:
    placed = blocks(spark, sf).select("state", "county", "tract")
    orders = table(spark, sf, "orders")
    return placed.join(orders, F.col("tract") == F.col("o_custkey")).groupBy("state", "county").agg(
        F.round(F.avg("o_totalprice"), 2).alias("mean_county_income"))


def density(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("zip")).agg(
        F.count(F.lit(1)).cast("double").alias("zip_area_sq_miles"),
        F.max("s_acctbal").alias("zip_density_sq_miles"))


# --- event stream: users as entities ---

LAG_DAYS = ("case event_type when 'signup' then 0 when 'view' then 1 when 'click' then 2 "
            "when 'purchase' then 3 else 4 end")


# amounts are decimals: their sums are exact, so equal sums stay ties whatever the order of addition
def entity_events(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("user_id").alias("entity_id"), "event_id", F.to_date("ts").alias("event_date"),
        F.date_add(F.to_date("ts"), F.expr(LAG_DAYS)).alias("knowledge_date"),
        (kind == "error").cast("int").alias("found_violation"),
        (kind == "signup").cast("int").alias("citizen_complaint"),
        F.when(kind == "purchase", F.col("value")).otherwise(0.0).cast("decimal(12,2)").alias("penalty_amount"))


def entity_labels(spark: SparkSession, sf: str) -> DataFrame:
    return entity_events(spark, sf).select(
        "entity_id", "event_id", "event_date", "knowledge_date",
        (F.col("penalty_amount") > 50).cast("int").alias("label"))


def order_events(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' orders: first dates lie years apart, so cohorts differ by split."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity_id"), F.to_date("o_orderdate").alias("event_date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("found_violation"))


ORDER_TEMPORAL = {"feature_start_time": "1995-01-01", "feature_duration": "6 months", "label_duration": "3 months",
                  "feature_aod_interval": "3 months", "train_repeat_interval": "3 months", "num_train_repeat": 3}


def daily_panel(spark: SparkSession, sf: str) -> DataFrame:
    """One dated record per user and day with events."""
    events = table(spark, sf, "events")
    return events.groupBy(F.col("user_id").alias("entity_id"), F.to_date("ts").alias("event_date")).agg(
        F.count(F.lit(1)).alias("day_events"), F.round(F.sum("value"), 2).alias("day_value"))


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity_id"), "c_acctbal", "c_nationkey", "c_mktsegment")


def semantic_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"events": entity_events(spark, sf), "labels": entity_labels(spark, sf),
            "reporting": daily_panel(spark, sf), "acs": profiles(spark, sf)}


TEMPORAL = {"feature_start_time": "2024-01-01", "feature_duration": "10 days", "label_duration": "5 days",
            "feature_aod_interval": "5 days", "train_repeat_interval": "5 days", "num_train_repeat": 3}

EVENT_BLOCK = {
    "prefix": "events", "from_table": "semantic.{prefix}_events", "table_type": "event",
    "event_date_column_name": "event_date", "knowledge_date_column_name": "knowledge_date",
    "imputation": {"sum": "zero", "avg": "zero_noflag", "datediff": "inf"},
    "aggregates": [
        {"column_name": "found_violation", "metrics": ["sum", "avg"], "time_windows": ["all", "7 days", "14 days"]},
        {"column_name": "citizen_complaint", "metrics": ["sum"], "time_windows": ["all", "7 days"]},
        {"column_name": "penalty_amount", "metrics": ["sum"], "time_windows": ["all", "7 days"]},
        {"column_name": "event_date", "metrics": ["datediff"]},
    ],
}
STATIC_BLOCK = {"prefix": "acs", "from_table": "semantic.{prefix}_acs", "table_type": "entity",
                "imputation": "mean_noflag", "columns": ["c_acctbal", "c_nationkey"]}
PANEL_BLOCK = {"prefix": "reporting", "from_table": "semantic.{prefix}_reporting", "table_type": "entity",
               "imputation": "zero", "event_date_column_name": "event_date"}

EXPERIMENT = {
    "version": "v1", "experiment_name": "baselines", "temporal_config": TEMPORAL,
    "feature_config": [STATIC_BLOCK, PANEL_BLOCK, EVENT_BLOCK],
    "model_config": {"RankBaseline": {
        "column": ["events_sum_penalty_amount", "events_sum_found_violation", "events_days_since_event_date"]}},
    "eval_config": {"metrics": ["precision_score", "recall_score", "num_labeled_samples"], "k": [50, 0.1, 1.0]},
}


GRID = {
    "LogisticRegression": {"penalty": ["l1", "l2", "elasticnet", "none"], "C": [0.1], "l1_ratio": [0.5],
                           "max_iter": [20]},
    "tree.DecisionTreeClassifier": {"max_depth": [1, None], "min_samples_split": [10]},
    "ensemble.RandomForestClassifier": {"n_estimators": [10], "max_depth": [2], "max_features": ["auto"]},
    "ensemble.GradientBoostingClassifier": {"n_estimators": [5], "learning_rate": [0.1], "subsample": [1],
                                            "max_depth": [2], "max_features": [None]},
    "RankBaseline": {"column": ["n_chars"], "sort": ["desc", "asc"]},
    "unknown.Classifier": {"depth": [1]},
}


#: Models with one 0/1 feature, whose scores have closed forms.
EXACT_GRID = {
    "LogisticRegression": {"penalty": ["none"], "max_iter": [200]},
    "tree.DecisionTreeClassifier": {"max_depth": [1]},
    "ensemble.RandomForestClassifier": {"n_estimators": [10], "max_depth": [1], "max_features": [None]},
    "ensemble.GradientBoostingClassifier": {"n_estimators": [1], "learning_rate": [1.0], "max_depth": [1],
                                            "max_features": [None]},
}


MANY_GRID = {
    "LogisticRegression": {"penalty": ["l1", "l2", "elasticnet", "none"], "C": [0.001, 0.01, 0.1, 1, 10, 100],
                           "l1_ratio": [0.5], "max_iter": [1000]},
    "tree.DecisionTreeClassifier": {"max_depth": [1, 2, 5, 10, 50, 100, None], "min_samples_split": [2, 5, 10, 20]},
}


# --- scored population: documents, partly labeled ---

DOCUMENT_FEATURES = ["n_chars", "n_words", "n_lines"]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf, "documents").select(
        F.lit(0).alias("split_id"), F.col("doc_id").alias("entity_id"), "n_chars",
        F.size(F.split(text, " ")).alias("n_words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"))


def long_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("split_id", "entity_id", (F.col("n_chars") >= 1500).cast("double").alias("is_long"))


def document_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        F.lit(0).alias("split_id"), F.col("doc_id").alias("entity_id"), F.col("quality").alias("label"))


def document_scores(spark: SparkSession, sf: str) -> DataFrame:
    models = F.array(*[F.struct(F.lit(f"by_{c}").alias("model_id"), F.col(c).cast("double").alias("probability"))
                       for c in ("n_chars", "n_words")])
    return documents(spark, sf).select("split_id", "entity_id", F.explode(models).alias("_m")).select(
        "split_id", "entity_id", "_m.*")
