"""Print the formatted physical plan of a job: python scripts/explain.py <job> [sf_dir]"""
import sys

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from webloom.plans.jobs import JOBS  # noqa: E402
from webloom.session import build_session  # noqa: E402

if __name__ == "__main__":
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    JOBS[name](spark, sf).explain("formatted")
