"""Launcher for the batch job:

    spark-submit --py-files stayflow.zip tools/refresh.py --claims DIR --bene DIR --state FILE --out DIR
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayflow.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
