import glob
import os

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.01"


def rows_of(name, sf=SMALL):
    path = f"{sf}/{name}.parquet"
    files = sorted(glob.glob(f"{path}/*")) if os.path.isdir(path) else [path]
    return [r for f in files for r in pq.read_table(f).to_pylist()]
