"""From raw tables to the semantic layer.

Only what the wanted outputs need is planned.  Tables that several outputs read, and
ranks whose ranges are sampled, are written to the shared folder while planning.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank import presets
from riskrank.operators.asof import asof_latest_version
from riskrank.operators.cleaning import clean_entities, clean_reports, link_geography, load_demographics
from riskrank.operators.geography import geo_demographics
from riskrank.operators.panel import reporting_panel
from riskrank.operators.ranking import assign_surrogate_ids
from riskrank.operators.rollups import rollup_events, rollup_labels
from riskrank.session import cut_lineage, scratch_scope
from riskrank.sources.readers import load_zip_density, read_query
from riskrank.sources.sinks import ensure_layers, write_table

Tables = dict[str, DataFrame]
Step = Callable[[SparkSession, Tables], Tables] | tuple[str, str]


@dataclass(frozen=True)
class Domain:
    """Column names and code lists of the raw tables; defaults fit the regulated-waste data."""

    entity_key: str = presets.ENTITY_KEY
    entity_columns: Sequence[str] = tuple(presets.ENTITY_COLUMNS)
    entity_renames: Mapping[str, str] = field(default_factory=lambda: presets.ENTITY_RENAMES)
    region_column: str = presets.ENTITY_REGION_COLUMN
    region: str = presets.ENTITY_REGION
    version_date: str = "receive_date"
    version_tiebreak: Sequence[str] = ("handler_sequence_number", "source_type")
    evaluation_key: str = "handler_id"
    evaluation_date: str = "evaluation_start_date"
    evaluation_columns: Sequence[str] = tuple(presets.EVALUATION_COLUMNS)
    known_dates: Sequence[str] = tuple(presets.KNOWLEDGE_DATES)
    violation_flag: str = "found_violation_flag"
    complaint_flag: str = "citizen_complaint_flag"
    amount: str = "final_amount"
    yes: str = "Y"
    report_key: str = "handler_id"
    report_columns: Sequence[str] = tuple(presets.REPORT_COLUMNS)
    report_lower: Sequence[str] = ("waste_description",)
    report_cycle: str = "report_cycle"
    report_code: str = "waste_code_group"
    report_tons: str = "generation_tons"
    code_categories: Mapping[str, str] = field(default_factory=lambda: presets.CODE_CATEGORIES)
    code_prefixes: Mapping[str, str] = field(default_factory=lambda: presets.CODE_PREFIXES)
    code_default: str = presets.CODE_DEFAULT
    panel_categories: Sequence[str] = tuple(presets.PANEL_CATEGORIES)
    population: str = "B01003_001E"


def load_sources(
    spark: SparkSession, block_groups: str | Sequence[str], county_income: str, density: str, *,
    census_names: Mapping[str, str] = presets.CENSUS_NAMES,
    income_columns: Sequence[str] = tuple(presets.INCOME_QUINTILES),
) -> Tables:
    """Demographics and density from landed CSV files; all county files are one read."""
    places = ["state", "county", "tract", "block group"]
    schema = ", ".join([f"`{c}` string" for c in places] + [f"`{c}` double" for c in census_names])
    income = ", ".join(["county string"] + [f"`{c}` double" for c in income_columns])
    return {
        "demographics": load_demographics(
            spark.read.csv(block_groups, schema=schema, header=True),
            spark.read.csv(county_income, schema=income, header=True), census_names, income_columns=income_columns),
        "density": load_zip_density(spark, density),
    }


#: Outputs of the semantic layer.
OUTPUTS = ("events", "labels", "reporting", "acs")


def clean_layer(raw: Mapping[str, DataFrame], domain: Domain = Domain(), outputs: Sequence[str] = OUTPUTS) -> Tables:
    """Entity versions, inspections matched to versions, reports, ids and linked census blocks.

    `inspections` has all columns and stays lazy; `inspected` is its written core.
    `raw` has entities, evaluations, reports, and optionally demographics and link.
    Parts that none of `outputs` needs are left out.
    """
    d = domain
    versions = clean_entities(raw["entities"], region_column=d.region_column, region=d.region,
                              columns=d.entity_columns, rename=d.entity_renames)
    out = {"versions": versions, "entity_ids": assign_surrogate_ids(
        versions.withColumnRenamed(d.entity_key, "id_number"), ["id_number"])}
    if "reporting" in outputs:
        out["reports"] = clean_reports(raw["reports"], versions, report_key=d.report_key,
                                       entity_key=d.entity_key, columns=d.report_columns, lower=d.report_lower)
    if "acs" in outputs and "demographics" in raw:
        out["acs"] = link_geography(raw["demographics"], raw["link"])
    if not {"events", "labels"} & set(outputs):
        return out
    evaluations = raw["evaluations"].select(d.evaluation_key, *d.evaluation_columns)
    inspections = asof_latest_version(
        evaluations, versions,
        event_key=d.evaluation_key, event_ts=d.evaluation_date,
        version_key=d.entity_key, version_ts=d.version_date,
        event_order=[F.col(c).asc_nulls_last() for c in evaluations.columns],
        version_order=[F.col(c).desc_nulls_last() for c in d.version_tiebreak]
        + [F.col(c).asc_nulls_last() for c in versions.columns if c not in d.version_tiebreak],
    )
    if d.evaluation_key != d.entity_key:
        inspections = inspections.drop(d.evaluation_key)
    # the few columns that both rollups and the event ids read
    inspected = cut_lineage(inspections.select(*dict.fromkeys([
        d.entity_key, d.version_date, d.evaluation_date, *d.known_dates, d.violation_flag,
        d.complaint_flag, d.amount])))
    return out | {"inspections": inspections, "inspected": inspected,
                  "event_ids": assign_surrogate_ids(inspected, [d.entity_key, d.version_date])}


def semantic_layer(
    cleaned: Tables, raw: Mapping[str, DataFrame], domain: Domain = Domain(), outputs: Sequence[str] = OUTPUTS,
) -> Tables:
    """The wanted of events, labels, the reporting panel and, where its sources are given, demographics."""
    d, out = domain, {}
    shared = dict(key=d.entity_key, version=d.version_date, event_date=d.evaluation_date,
                  known_dates=list(d.known_dates), amount=d.amount)
    ids = [cleaned.get(n) for n in ("inspected", "entity_ids", "event_ids")]
    if "events" in outputs:
        out["events"] = rollup_events(*ids, **shared, violation=F.col(d.violation_flag) == d.yes,
                                      complaint=F.col(d.complaint_flag) == d.yes)
    if "labels" in outputs:
        out["labels"] = rollup_labels(*ids, **shared)
    if "reporting" in outputs:
        out["reporting"] = reporting_panel(
            cleaned["reports"], cleaned["entity_ids"], key=d.report_key, cycle=d.report_cycle,
            code=d.report_code, tons=d.report_tons, exact=d.code_categories,
            prefixes=d.code_prefixes, default=d.code_default, categories=d.panel_categories)
    if "acs" in outputs and "acs" in cleaned:
        blocks = raw["census"].withColumnRenamed(d.population, "population")
        out["acs"] = geo_demographics(raw["facilities"], blocks, raw["link"], raw["density"],
                                      cleaned["acs"], cleaned["entity_ids"])
    return out


def run_steps(
    spark: SparkSession, steps: Sequence[Step], tables: Mapping[str, DataFrame] | None = None,
    *, prefix: str = "", **values,
) -> Tables:
    """Run a user's own steps in order, each seeing the tables made before it.

    A step is a function (spark, tables) -> new tables, or a pair (name, SELECT) in
    which `{prefix}` is replaced and `:name` takes a value.  Tables are temporary
    views, so the steps stay one lazy plan.
    """
    made: Tables = dict(tables or {})
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    for step in steps:
        if callable(step):
            new = step(spark, made)
        else:
            name, query = step
            name = name.replace("{prefix}", prefix)
            new = {name: read_query(spark, query, replace={"prefix": prefix}, **values)}
        for name, df in new.items():
            df.createOrReplaceTempView(name)
        made.update(new)
    return made


def run_preprocessing(
    raw: Mapping[str, DataFrame], domain: Domain = Domain(), *,
    outputs: Sequence[str] = OUTPUTS, persist: bool = False,
    extra_steps: Sequence[Step] = (), prefix: str = "", spark: SparkSession | None = None,
) -> Tables:
    """The semantic layer: the wanted of events, labels, reporting, acs, then the user's own steps.

    With `persist` the layer is written once to the catalog, as `semantic.{prefix}_{name}`,
    where any number of experiments read it under the same prefix; scratch tables made
    on the way are deleted.
    """
    if unknown := set(outputs) - set(OUTPUTS):
        raise ValueError(f"no such outputs: {sorted(unknown)}")
    spark = spark or next(iter(raw.values())).sparkSession
    if persist:
        ensure_layers(spark, ["semantic"])
        with scratch_scope(spark):
            made = _layers(raw, domain, outputs, extra_steps, prefix, spark)
            return {name: write_table(df, f"semantic.{prefix}_{name}" if name in OUTPUTS else f"semantic.{name}")
                    for name, df in made.items() if name not in CLEANED}
    return _layers(raw, domain, outputs, extra_steps, prefix, spark)


#: Tables of the cleaned layer; they serve the semantic one and the user's steps.
CLEANED = ("versions", "inspections", "inspected", "reports", "entity_ids", "event_ids")


def _layers(raw, domain, outputs, extra_steps, prefix, spark) -> Tables:
    cleaned = clean_layer(raw, domain, outputs)
    out = semantic_layer(cleaned, raw, domain, outputs)
    if extra_steps:
        out = run_steps(spark, extra_steps, {**cleaned, **out}, prefix=prefix)
    return out
