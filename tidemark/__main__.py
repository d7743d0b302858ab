"""python -m tidemark run --config-file FILE --source-dir DIR --replica-dir DIR [--follow]"""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from tidemark.plans.config import from_json
from tidemark.plans.runner import DocumentPipe, RelationalPipe
from tidemark.sources.files import DocumentFiles, RelationalFiles
from tidemark.streaming.progress import Progress


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description="Keeps replicas of tables or collections up to date.")
    run = parser.add_subparsers(dest="command", required=True).add_parser("run", help="copy once, then apply all changes there are, or follow them")
    run.add_argument("--config-file", required=True)
    run.add_argument("--source-dir", required=True, help="files in the source's wire formats")
    run.add_argument("--replica-dir", required=True)
    run.add_argument("--follow", action="store_true", help="go on following changes until interrupted")
    run.add_argument("--compact-every", type=int, default=100, help="batches after which a replica's log becomes its base")
    run.add_argument("--mode", choices=("ordered", "batchwise"), default="ordered")
    args = parser.parse_args(argv)
    config = from_json(Path(args.config_file).read_text(encoding="utf-8"))
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    spark.streams.addListener(Progress())
    relational = config.source.source_type == "postgres"
    pipe, files = (RelationalPipe, RelationalFiles) if relational else (DocumentPipe, DocumentFiles)
    pipe(spark, config, files(spark, args.source_dir), args.replica_dir, args.mode, args.compact_every).run(args.follow)


if __name__ == "__main__":
    main()
