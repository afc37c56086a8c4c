"""Run ingest streams: ``spark-submit run_ingest.py --root <folder> weather orders``.

Without names all datasets are ingested, each as its own stream of one application.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from .session import create_session
from .sources.messages import BOOTSTRAP_SERVERS, OFFSETS_PER_BATCH, stream_kafka, stream_text
from .specs import all_specs, get_spec
from .streaming.ingest import run_all
from .warehouse import Warehouse

logger = logging.getLogger(__name__)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("datasets", nargs="*", help="datasets to ingest (default: all)")
    parser.add_argument("--root", required=True, help="folder of tables and checkpoints")
    parser.add_argument("--bootstrap-servers", default=BOOTSTRAP_SERVERS)
    parser.add_argument(
        "--starting-offsets", default="latest", help="where a stream without checkpoint starts"
    )
    parser.add_argument("--max-offsets", type=int, default=OFFSETS_PER_BATCH)
    parser.add_argument("--min-partitions", type=int, help="read a topic with at least so many tasks")
    parser.add_argument("--text", help="read <folder>/<dataset>/*.txt instead of Kafka")
    parser.add_argument("--probe-days", type=int, help="look up keys only around a batch's dates")
    parser.add_argument("--buckets", type=int, help="bucket tables by key, instead of dates")
    parser.add_argument("--any-age", action="store_true", help="accept messages of any age")
    parser.add_argument("--once", action="store_true", help="take what is there, then stop")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    options = _arguments().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    specs = [get_spec(name) for name in options.datasets] or all_specs()
    spark = create_session("ingest-" + "-".join(spec.name for spec in specs))
    layout = {} if options.probe_days is None else {"probe_days": options.probe_days}
    warehouse = Warehouse(spark, options.root, options.buckets, **layout)
    settings = {"max_age_ms": None} if options.any_age else {}

    def messages(spec):
        if options.text:
            return stream_text(spark, f"{options.text}/{spec.name}")
        return stream_kafka(
            spark,
            spec.topic,
            bootstrap_servers=options.bootstrap_servers,
            starting_offsets=options.starting_offsets,
            max_offsets=options.max_offsets,
            min_partitions=options.min_partitions,
        )

    jobs = [warehouse.job(spec, messages(spec), **settings) for spec in specs]
    run_all(jobs, {"availableNow": True} if options.once else None)
