"""Layered build, test and analysis runs (L1-L4, S7).

Layer order is fixed (staging -> intermediate -> marts); inside a layer the
models are independent, are reported in name order and are built as
concurrent jobs.  Staging is a view; the bridges and the mart are written as
Parquet tables under the session's shared checkpoint folder, which also cuts
lineage so lost executors only redo the current layer.  ``Warehouse.open``
reads a finished build back, in any session.
"""

from __future__ import annotations

import functools
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import clean
from marquee.operators import file_sketches

from marquee.plans import analyses as A
from marquee.plans import assertions as T
from marquee.plans.jobs import DEFAULT_CONCURRENT_JOBS, run_concurrently
from marquee.plans.models import Catalogue
from marquee.session import workspace_dir
from marquee.sources import sinks
from marquee.sources.landing import require_inputs

#: Columns whose distinct values are kept as sketches (``Warehouse.keep_sketches``).
SKETCHED = {
    "raw": ("country", "listed_in"),
    "int_title_countries": ("country",),
    "int_title_genres": ("genre", "genre_normalised"),
}

LAYERS = (
    ("staging", "view", ("stg_titles",)),
    ("intermediate", "table", ("int_title_countries", "int_title_genres", "int_title_people")),
    ("marts", "table", ("dim_title",)),
)


@dataclass
class Built:
    layer: str
    model: str
    materialisation: str
    rows: int
    seconds: float


class Warehouse:
    """A built catalogue: model name -> DataFrame over materialised files."""

    seconds = 0.0

    def __init__(self, root: str, cat: Catalogue, models: dict[str, DataFrame],
                 report: list[Built]):
        self.root, self.catalogue, self.models, self.report = root, cat, models, report

    @staticmethod
    def open(spark: SparkSession, root: str) -> "Warehouse":
        """A finished build's tables, from this or another session, also by name
        in ``spark.sql`` (``register_views``)."""
        paths = {name: f"{root}/{layer}/{name}" for layer, mat, names in LAYERS for name in names
                 if mat == "table"}
        require_inputs(spark, f"{root}/raw", *paths.values())
        models = {name: sinks.open_table(spark, path) for name, path in paths.items()}
        cat = Catalogue(sinks.open_table(spark, f"{root}/raw"), models=models)
        wh = Warehouse(root, cat, {"stg_titles": cat.staging, **models}, [])
        wh.register_views()
        return wh

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every built model under its name as a temp view, so
        analysts' SQL (``SELECT ... FROM dim_title JOIN int_title_countries
        ...``) runs through ``spark.sql`` against the written tables."""
        names = []
        for name, df in self.models.items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def keep_sketches(self) -> DataFrame:
        """Sketches of the columns whose distinct values Q01 counts, for each
        file of the landing and the bridges, written as ``<root>/sketches``."""
        spark = self.catalogue.raw.sparkSession
        found = []
        for table, columns in SKETCHED.items():
            df = self.catalogue.raw if table == "raw" else self.models[table]
            if table == "raw":
                # Blank cells count as one value of the packed column, as in Q01.
                df = df.select(*[clean(c).alias(c) for c in columns], "_metadata")
            found.append(file_sketches(df, list(columns)).withColumn("table", F.lit(table)))
        return sinks.as_table(functools.reduce(DataFrame.unionByName, found), f"{self.root}/sketches")

    def report_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(b.layer, b.model, b.materialisation, int(b.rows), float(b.seconds))
                for b in self.report]
        return spark.createDataFrame(
            rows, "layer string, model string, materialisation string, rows bigint, "
                  "seconds double")

    def total(self) -> tuple[int, float]:
        """The build's grand total: rows of all models, and the seconds from start to end."""
        return sum(b.rows for b in self.report), self.seconds


def _model_frame(cat: Catalogue, model: str) -> DataFrame:
    return {
        "stg_titles": lambda: cat.staging,
        "int_title_countries": lambda: cat.countries,
        "int_title_genres": lambda: cat.genres,
        "int_title_people": lambda: cat.people,
        "dim_title": lambda: cat.mart,
    }[model]()


def build(raw: DataFrame, root: str | None = None,
          max_jobs: int = DEFAULT_CONCURRENT_JOBS) -> Warehouse:
    """L1: build every layer in order, recording rows and seconds per model
    (S7).  The landing is kept as ``<root>/raw``, so the build starts from
    files, not from upstream plans; a frame that ``land`` returned is built
    where it stands.  The returned warehouse's catalogue reads the written
    tables."""
    spark = raw.sparkSession
    landed = getattr(raw, "landed_root", None)
    if root is None:
        root = landed or workspace_dir(spark, "warehouse-" + str(int(time.time() * 1000)))
    begun = time.time()
    # A build is whole: tests read the landing beside the models.
    kept = raw if landed == root else land(raw, root)
    cat = Catalogue(kept)
    models: dict[str, DataFrame] = {}
    report: list[Built] = []

    def make(layer: str, mat: str, name: str):
        df = _model_frame(cat, name)
        if mat == "view":
            df = sinks.as_view(df, name)
            return df, df.count()
        return sinks.as_counted_table(df, f"{root}/{layer}/{name}")

    for layer, mat, names in LAYERS:
        tasks = {n: (lambda n=n: make(layer, mat, n)) for n in sorted(names)}
        if layer == "staging":
            # The key check (which plan the next layers use) is its own
            # small job; run it beside the staging count.
            tasks["_unique_keys"] = lambda: cat.unique_keys
        done = run_concurrently(tasks, max_jobs)
        for name in [*names, *(["_unique_keys"] if layer == "staging" else [])]:
            res, secs = done[name]
            if isinstance(res, Exception):
                raise res
            if name in names:
                models[name], rows = res
                report.append(Built(layer, name, mat, rows, secs))
    report.sort(key=lambda b: ([x[0] for x in LAYERS].index(b.layer), b.model))
    tables = {n: df for n, df in models.items() if n != "stg_titles"}
    wh = Warehouse(root, cat.with_models(tables), models, report)
    wh.seconds = time.time() - begun
    wh.register_views()
    return wh


def land(raw: DataFrame, root: str | None = None) -> DataFrame:
    """Persist a landing as Parquet (all text) under ``<root>/raw`` and return
    a reader of it, which knows its root."""
    spark = raw.sparkSession
    if root is None:
        root = workspace_dir(spark, "landing-" + str(int(time.time() * 1000)))
    kept = sinks.as_table(raw, f"{root}/raw")
    kept.landed_root = root
    return kept


def run_tests(cat: Catalogue, stop_on_failure: bool = True, **kw) -> list[T.AssertionResult]:
    """L2 test step: run the suite; optionally stop when anything failed."""
    results = T.run_suite(cat, **kw)
    if stop_on_failure:
        T.require_all_pass(results)
    return results


def run_analyses(cat: Catalogue, out_dir: str | None = None, preview_rows: int = 25,
                 max_jobs: int = DEFAULT_CONCURRENT_JOBS) -> list[dict]:
    """L3: run every analysis, write each as headed CSV (S8) and keep a
    short preview (S9); results in name order, jobs run concurrently.

    Each analysis runs once: its (small, aggregated) result is persisted
    for the write and the ordered preview, then released.  The result is
    written in parallel (one folder of headed CSV parts; small results come
    out as one part after AQE coalescing), never funnelled into one task."""
    cat.unique_keys  # decide the plan once, before the threads start

    def one(name: str) -> dict:
        df = A.ANALYSES[name](cat).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            path = sinks.write_result_csv(df, f"{out_dir}/{name}") if out_dir else None
            head, rest = sinks.preview(df, preview_rows)
        finally:
            df.unpersist()
        return {"analysis": name, "path": path, "preview": head, "rows": len(head) + rest}

    done = run_concurrently({n: (lambda n=n: one(n)) for n in sorted(A.ANALYSES)}, max_jobs)
    out = []
    for name, (res, secs) in done.items():
        if isinstance(res, Exception):
            raise res
        res["seconds"] = secs
        out.append(res)
    return out


def run(raw: DataFrame | None = None, mode: str = "both", root: str | None = None,
        max_year: int | None = None, stop_on_failure: bool = True,
        spark: SparkSession | None = None) -> tuple[Warehouse, list | None]:
    """L2: ``build``, ``test`` or ``both`` (build then test).

    ``test`` checks the stored tables of the build at ``root`` and needs no
    landing.  A failed assertion stops the run unless ``stop_on_failure`` is
    off."""
    if mode not in ("build", "test", "both"):
        raise ValueError(mode)
    if mode == "test":
        if root is None:
            raise ValueError("mode 'test' needs the root of a finished build")
        wh = Warehouse.open(spark or (raw.sparkSession if raw is not None
                                      else SparkSession.getActiveSession()), root)
    else:
        wh = build(raw, root)
    results = None
    if mode in ("test", "both"):
        results = run_tests(wh.catalogue, stop_on_failure=stop_on_failure, max_year=max_year)
    return wh, results
