"""``python -m pulsetide``: run a layer, as a stream or as a batch, or query the layers.

    python -m pulsetide bronze --root s3a://bucket/vitals --brokers host:9092
    python -m pulsetide silver --root s3a://bucket/vitals
    python -m pulsetide gold   --root s3a://bucket/vitals [--batch [--out PATH]]
    python -m pulsetide check  --root s3a://bucket/vitals
    python -m pulsetide summary --root s3a://bucket/vitals --user user_001 --metric steps
"""

import argparse

from pulsetide.plans.command import run


def arguments() -> argparse.Namespace:
    """The parsed command line."""
    parser = argparse.ArgumentParser(prog="pulsetide", description="Health telemetry on Spark")
    parser.add_argument(
        "job", choices=["bronze", "silver", "gold", "check", "users", "summary"]
    )
    parser.add_argument("--root", required=True, help="folder that holds the layers")
    parser.add_argument("--brokers", default="localhost:9092", help="Kafka bootstrap servers")
    parser.add_argument("--topic", default=None, help="Kafka topic")
    parser.add_argument(
        "--option",
        action="append",
        default=[],
        metavar="KEY=VALUE",
        help="bronze: an option of the Kafka source, such as maxOffsetsPerTrigger=1000000",
    )
    parser.add_argument(
        "--packages",
        action="append",
        default=[],
        help="bronze: more packages, such as an object-store connector; configured ones stay",
    )
    parser.add_argument("--batch", action="store_true", help="gold: run once over all of silver")
    parser.add_argument("--out", default=None, help="another gold folder, or a report as JSON")
    parser.add_argument("--once", action="store_true", help="take what is there and stop")
    parser.add_argument("--every", default=None, help="trigger interval, such as '30 seconds'")
    parser.add_argument("--files", type=int, default=None, help="output tasks per batch")
    parser.add_argument("--date-files", type=int, default=None, help="files per date and batch of a stream")
    parser.add_argument("--codec", default="snappy", help="compression of what a stream writes")
    parser.add_argument("--max-files", type=int, default=None, help="input files per trigger, 0 for all; unsafe unless files are in event order")
    parser.add_argument("--user", default=None, help="summary: the user asked for")
    parser.add_argument("--as-of", default=None, help="summary: end of the look-back, ISO-8601")
    parser.add_argument("--metric", default=None, help="summary: the metric asked for")
    return parser.parse_args()


if __name__ == "__main__":
    run(arguments())
