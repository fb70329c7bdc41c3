"""spark-submit launcher for the medallion jobs.

    spark-submit --py-files lakeweave.zip run_job.py gold --name revenue --duration "5 minutes" --root s3a://lake

(``lakeweave.zip``: ``zip -r lakeweave.zip lakeweave``; or install the
package on the cluster).  See ``lakeweave/jobs.py`` for every job and flag.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeweave.jobs import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
