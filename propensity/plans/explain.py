"""Print the formatted physical plan of registered queries.

    python -m propensity.plans.explain /root/testdata/sf0.01 split_stratified_exact folds_stratified

Queries that finish small driver-side steps eagerly (exact quantiles, the
split's boundary search, ranking metrics) run those steps while the frame
is built; the printed plan is the remaining lazy part.
"""

from __future__ import annotations

import sys

from ..session import build_session
from . import QUERIES


def main(argv=None) -> None:
    args = list(sys.argv[1:] if argv is None else argv)
    if not args:
        print(__doc__)
        return
    sf_dir, names = args[0], args[1:] or sorted(QUERIES)
    spark = build_session("local[*]", "propensity-explain", shuffle_partitions=8)
    for name in names:
        print("=" * 20, name)
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
