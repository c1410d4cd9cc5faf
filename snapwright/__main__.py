"""Run one full or incremental refresh: ``python -m snapwright --source ... --target ...``."""

from __future__ import annotations

import argparse
import json

from snapwright.plans.run import Settings, run, snapshot_table
from snapwright.session import build_session, ship_package
from snapwright.sources.catalog import SourceCatalog


def main(arguments: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="snapwright", description=__doc__)
    parser.add_argument("--source", required=True, help="folder of parquet tables, or a jdbc: URL")
    parser.add_argument("--target", required=True, help="folder of the published table")
    parser.add_argument("--bounds", default="{}", help='JSON: {"table": ["column", lowest, highest], ...} for jdbc')
    parser.add_argument("--provider", default="hashed", help="a registered encoder, or module:function of one")
    parser.add_argument("--provider-options", default="{}", help="JSON: arguments of the encoder")
    parser.add_argument("--texts-per-second", type=float, help="limit of a remote encoder for the whole job; needs --tasks")
    parser.add_argument("--full", action="store_true", help="rebuild everything, as edits outside services need")
    parser.add_argument("--dimension", type=int, default=1024)
    parser.add_argument("--batch-size", type=int, default=25)
    parser.add_argument("--tasks", type=int, help="encoders side by side")
    given = parser.parse_args(arguments)

    spark = build_session()
    ship_package(spark)
    settings = Settings(
        given.provider, given.dimension, given.batch_size, given.tasks, json.loads(given.provider_options),
        texts_per_second=given.texts_per_second,
    )
    if given.source.startswith("jdbc:"):
        bounds = {table: tuple(value) for table, value in json.loads(given.bounds).items()}
        catalog = SourceCatalog.from_jdbc(spark, given.source, bounds=bounds)
    else:
        catalog = SourceCatalog.from_parquet(spark, given.source)
    report = run(catalog, snapshot_table(spark, given.target, settings), settings, full=given.full)
    print(json.dumps({**report, "table": given.target}))
    return report


if __name__ == "__main__":
    main()
