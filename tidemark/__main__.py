"""Command line: ``python -m tidemark FOLDER QUERY|SQL|status``."""

from __future__ import annotations

import sys

from tidemark.plans import catalog, tools
from tidemark.session import session
from tidemark.sources.tables import TABLES


def main(args: list[str]) -> int:
    if len(args) != 2:
        print(__doc__)
        return 2
    folder, what = args
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    if what == "status":
        tools.status(spark, folder, TABLES).show(100, False)
    elif what in catalog.queries():
        catalog.queries()[what](spark, folder).show(50, 80)
    else:
        print(tools.sql_text(spark, what, folder))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
