"""Smoke: package imports, entry() runs, every query is registered."""

import re


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["bin", "bin_label", "n", "mae", "mape", "median_true"]


def test_every_survey_id_has_a_query():
    import __spark_entry__ as e
    q, o = e.queries(), e.oracle_sql()
    ids = {m.group(1) for k in q if (m := re.match(r"([a-o]\d+)_", k))}
    expected = ({f"a{i}" for i in range(1, 9)} | {f"b{i}" for i in range(1, 10)}
                | {f"c{i}" for i in range(1, 11)} | {f"d{i}" for i in range(1, 15)}
                | {f"e{i}" for i in range(1, 5)} | {f"f{i}" for i in range(1, 11)}
                | {f"g{i}" for i in range(1, 11)} | {f"h{i}" for i in range(1, 11)}
                | {f"i{i}" for i in range(1, 10)} | {f"j{i}" for i in range(1, 7)}
                | {f"k{i}" for i in range(1, 11)} | {f"l{i}" for i in range(1, 15)}
                | {f"m{i}" for i in range(1, 15)} | {f"n{i}" for i in range(1, 9)}
                | {"o1", "o2"})
    assert len(expected) == 138
    assert expected <= ids
    assert set(o) <= set(q)


def test_scratch_folder_without_setting(tmp_path):
    """A local session without ``spark.checkpoint.dir`` gets one folder, the same at every call."""
    import os
    import subprocess
    import sys
    code = ("from hearth.session import checkpoint_dir, cut_lineage, get_spark; s = get_spark(master='local[1]'); "
            "a = checkpoint_dir(s); assert a == checkpoint_dir(s); print('rows', cut_lineage(s.range(5)).count())")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120,
                         env={**os.environ, "SPARK_CONF_DIR": str(tmp_path), "TMPDIR": str(tmp_path)})
    assert "rows 5" in out.stdout, out.stderr[-2000:]
