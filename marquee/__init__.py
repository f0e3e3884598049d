"""marquee: catalogue cleaning and analytics on Spark.

Layers (each a plain DataFrame builder, optimised by Catalyst + AQE):

* ``sources``   landing of text-only sources, contract and profile checks, sinks
* ``functions`` Column-expression helpers (trim, parse, band, round, ...)
* ``operators`` reusable relational operators (shares, running totals,
                co-occurrence pairs, distribution summaries, profiles)
* ``plans``     the models (staging, bridges, mart), analyses, assertions,
                report data and the layered build

Typical use::

    from marquee import get_session, read_csv_landing, land, build, run_tests
    spark = get_session()
    wh = build(land(read_csv_landing(spark, "catalogue.csv")))
    run_tests(wh.catalogue)
"""

from marquee.session import cluster_conf, get_session, workspace_dir
from marquee.plans.models import Catalogue
from marquee.plans.build import build, land, run, run_analyses, run_tests
from marquee.sources.landing import read_csv_landing
from marquee.sources.synthetic import synthetic_landing

__all__ = [
    "get_session", "workspace_dir", "cluster_conf", "Catalogue", "build", "land", "run",
    "run_analyses", "run_tests", "read_csv_landing", "synthetic_landing",
]
