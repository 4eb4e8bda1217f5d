"""python -m tesserae NAME --option=value ..."""

import sys

from pyspark.sql import SparkSession

from tesserae.commands import COMMANDS
from tesserae.session import ensure_importable


def main(args: list[str]) -> int:
    if not args or args[0] not in COMMANDS:
        print("commands:", *sorted(COMMANDS))
        return 2
    options = {}
    for arg in args[1:]:
        name, _, value = arg.lstrip("-").partition("=")
        options[name.replace("-", "_")] = {"true": True, "false": False, "": True}.get(value, value)
    spark = SparkSession.builder.getOrCreate()
    ensure_importable(spark)
    out = COMMANDS[args[0]](spark, **options)
    if out is not None:
        out.show(1000, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
