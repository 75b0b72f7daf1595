"""Steps from landed files to a checked model: ingest, load raw, set up, transform, check."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.functions.documents import trailing_id
from docfold.operators.chains import chain_faults, page_chain
from docfold.operators.checks import Check, evaluate, gate, stored_totals, summarise, violations
from docfold.operators.flatten import bridge, flatten
from docfold.operators.merge import reject_null_keys
from docfold.operators.reconcile import reconcile_stored
from docfold.operators.snapshots import latest_snapshot, page_faults, union_pages
from docfold.plans.series_model import (
    BRIDGE,
    CHARACTER_EPISODES,
    CHARACTER_FIELDS,
    DIM_CHARACTERS,
    DIM_EPISODES,
    EPISODE_FIELDS,
    MODEL_DATABASE,
    RAW_DATABASE,
    RAW_TABLES,
    series_checks,
)
from docfold.sources.envelopes import read_split_envelopes
from docfold.sources.landing import (
    latest_file,
    load_raw,
    load_records,
    read_envelopes,
    read_latest_records,
    read_manifests,
    read_pages,
    write_snapshot,
)
from docfold.sources.tables import (
    create_database,
    create_table,
    drop_old_versions,
    insert_only_table,
    replace_table,
    scan,
    upsert_table,
)

MODEL_TABLES = (DIM_CHARACTERS, DIM_EPISODES, BRIDGE)


class IncompleteInputError(Exception):
    """Landed pages are not one whole chain."""


@dataclass
class SeriesRun:
    """One run over ``landing``. Enveloped files are read from ``<landing>/<entity>/``.

    With ``pages``, page files from ``<pages>/<entity>/`` are first landed as record lines, which load in parallel.
    ``rejects`` holds bridge rows without a complete key after a transform. ``keep_versions`` limits the stored versions
    of each table: the current one, and those that running readers may still use. Enveloped files of more than ``split_above`` bytes are
    read by several tasks each. ``written`` has the rows last written into each table. ``results`` and ``checks`` are those of the
    last quality step, also if it failed.
    """

    spark: SparkSession
    landing: str
    pages: str | None = None
    raw_database: str = RAW_DATABASE
    model_database: str = MODEL_DATABASE
    keep_versions: int = 2
    split_above: int = 128 << 20
    metrics: list[tuple[str, int, float]] = field(default_factory=list)
    written: dict[str, int] = field(default_factory=dict)
    rejects: DataFrame | None = None
    results: DataFrame | None = None
    checks: dict[str, Check] = field(default_factory=dict)

    def setup(self) -> None:
        create_database(self.spark, self.raw_database)
        create_database(self.spark, self.model_database)

    def ingest(self) -> None:
        """Lands the pages of each entity; raises if they are not one whole chain."""
        for entity in RAW_TABLES:
            pages = read_pages(self.spark, f"{self.pages}/{entity}")
            faults = page_faults(pages, [], "page", "next", "results").first().asDict()
            if not any(faults.values()):
                faults = self._link_faults(pages)
            if any(faults.values()):
                raise IncompleteInputError(f"{entity} pages: {', '.join(f'{k} {v}' for k, v in faults.items() if v)}")
            records = union_pages(pages, ["page"]).select("record")
            write_snapshot(records, self.landing, entity, f"{self.pages}/{entity}")

    def _link_faults(self, pages: DataFrame) -> dict[str, int]:
        """What is wrong with the pages that ``next`` names; every address must end in a page number."""
        number = F.coalesce(trailing_id("next", strict=False), F.when(F.col("next").isNotNull(), -1))
        linked = pages.select("page", number.alias("next"))
        return chain_faults(page_chain(linked, [], "page", "next"), [], "page").drop("pages", "chain_length", "first_page").first().asDict()

    def load_raw(self) -> None:
        """Replaces RAW by the newest snapshot; the version before stays readable."""
        for entity, spec in RAW_TABLES.items():
            if self.pages:
                rows = load_records(read_latest_records(self.spark, self.landing, entity), id_type="int")
            else:
                newest = latest_file(self.spark, f"{self.landing}/{entity}", entity)
                large = self._is_large(newest)
                records = read_split_envelopes(self.spark, newest)[1] if large else read_envelopes(self.spark, newest)
                rows = load_raw(records, id_type="int")
            self.written[entity] = replace_table(self.spark, self.raw_database, spec, rows)
            drop_old_versions(self.spark, self.raw_database, spec, self.keep_versions)

    def verify_raw(self) -> DataFrame:
        """Per entity, the total its newest snapshot announced against the rows in RAW."""
        parts = []
        for entity in RAW_TABLES:
            stored = scan(self.spark, self.raw_database, entity)
            parts.append(reconcile_stored(self._declared(entity), stored).select(F.lit(entity).alias("entity"), "*"))
        return reduce(DataFrame.unionByName, parts)

    def _declared(self, entity: str) -> DataFrame:
        """``source_file, total_records`` of the newest snapshot."""
        if self.pages:
            manifests = read_manifests(self.spark, self.landing, entity)
            return latest_snapshot(manifests, [], "ingested_at").withColumnRenamed("snapshot", "source_file")
        newest = latest_file(self.spark, f"{self.landing}/{entity}", entity)
        heads = read_split_envelopes(self.spark, newest)[0] if self._is_large(newest) else read_envelopes(self.spark, newest)
        return heads.withColumnRenamed("file_name", "source_file")

    def _is_large(self, path: str) -> bool:
        """Whether a file is to be read by several tasks; only its size is looked at."""
        return self.spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] > self.split_above

    def setup_model(self) -> None:
        """Empties the model, so that the next transform is a full refresh."""
        for spec in MODEL_TABLES:
            create_table(self.spark, self.model_database, spec)

    def transform(self) -> None:
        """Upserts both dimensions, then adds new pairs to the bridge."""
        raw = {name: scan(self.spark, self.raw_database, name) for name in RAW_TABLES}
        now = self.spark.range(1).select(F.localtimestamp()).first()[0]
        for spec, entity, fields in ((DIM_CHARACTERS, "characters", CHARACTER_FIELDS), (DIM_EPISODES, "episodes", EPISODE_FIELDS)):
            rows = flatten(raw[entity], fields, load_ts=now)
            self.written[spec.name] = upsert_table(self.spark, self.model_database, spec, rows)
        pairs, self.rejects = reject_null_keys(bridge(raw["characters"], CHARACTER_EPISODES, load_ts=now), BRIDGE.key)
        self.written[BRIDGE.name] = insert_only_table(self.spark, self.model_database, BRIDGE, pairs)
        for spec in MODEL_TABLES:
            drop_old_versions(self.spark, self.model_database, spec, self.keep_versions)

    def quality(self) -> DataFrame:
        """Results of all checks, those of the announced totals included; raises if one of them blocks."""
        raw = {name: scan(self.spark, self.raw_database, name) for name in RAW_TABLES}
        model = {t.name: scan(self.spark, self.model_database, t.name) for t in MODEL_TABLES}
        checks = [*series_checks(raw, model)]
        checks += [stored_totals(self._declared(e), raw[e], f"TOTAL_{e.upper()}", e) for e in RAW_TABLES]
        self.checks = {c.name: c for c in checks}
        self.results = evaluate(checks)
        gate(self.results)
        return self.results

    def summary(self) -> DataFrame:
        """Totals and verdict of the last quality step."""
        return summarise(self.results)

    def violations(self, check_name: str) -> DataFrame:
        """The rows that break a check of the last quality step."""
        return violations(self.checks[check_name])

    def run(self, step: str = "all") -> DataFrame | None:
        """Runs one step, or all in order; returns the check results if they were computed.

        A failing step is timed as well, with 0 rows unless it is the checks that failed.
        """
        steps = self._steps()
        if step not in (*steps, "all"):
            raise ValueError(f"no step {step}; there are {', '.join(steps)} and all")
        results = None
        for name, action in steps.items():
            if step in (name, "all"):
                started, done = time.monotonic(), False
                try:
                    outcome = action()
                    done = True
                finally:
                    self.metrics.append((name, self._rows(name) if done or name == "quality" else 0, time.monotonic() - started))
                results = outcome if name == "quality" else results
        return results

    def run_metrics(self) -> DataFrame:
        """One row per step: rows it landed or wrote, or checks it ran; seconds, rows per second."""
        schema = "step string, n_rows bigint, seconds double"
        speed = F.when(F.col("seconds") > 0, F.round(F.col("n_rows") / F.col("seconds"), 2))
        return self.spark.createDataFrame(self.metrics, schema).withColumn("rows_per_second", speed)

    def _steps(self) -> dict[str, Callable]:
        steps = {"setup": self.setup}
        if self.pages:
            steps["ingest"] = self.ingest
        return {
            **steps,
            "load-raw": self.load_raw,
            "setup-model": self.setup_model,
            "transform": self.transform,
            "quality": self.quality,
        }

    def _rows(self, step: str) -> int:
        """Rows that a step wrote, as its writes observed them, or landed, as the manifests say; no data is read again."""
        tables = {"load-raw": RAW_TABLES, "transform": [t.name for t in MODEL_TABLES]}
        if step == "quality":
            return self.results.count() if self.results is not None else 0
        if step == "ingest":
            newest = [self._declared(entity).select("total_records") for entity in RAW_TABLES]
            return reduce(DataFrame.unionAll, newest).agg(F.sum("total_records")).first()[0]
        return sum(self.written[name] for name in tables.get(step, ()))
