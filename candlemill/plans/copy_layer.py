"""Copy a Parquet layer to another store.

    spark-submit candlemill/plans/copy_layer.py --source-path P --target-path T
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if not __package__:  # started as a script: the package lies two folders up
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from candlemill.session import get_session, object_store_conf  # noqa: E402
from candlemill.sources.store import copy_layer  # noqa: E402


def main(argv: list[str] | None = None) -> dict[str, int]:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source-path", required=True)
    parser.add_argument("--target-path", required=True)
    parser.add_argument("--app-name", default="copy_layer")
    args = parser.parse_args(argv)
    spark = get_session(args.app_name, **object_store_conf())
    df = spark.read.parquet(args.source_path)
    df.printSchema()
    df.show(5, truncate=False)
    counts = copy_layer(spark, args.source_path, args.target_path)
    print(counts)
    if counts["rows_written"] != counts["rows_read"]:
        raise RuntimeError(f"copy differs from its source: {counts}")
    return counts


if __name__ == "__main__":
    main()
