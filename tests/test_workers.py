"""Functions sent to Python workers must load where this package is not importable."""

import subprocess
import sys

from pyspark import cloudpickle

from tripflow.sources import footers

LOADER = """
import pickle, sys
sys.path[:] = [p for p in sys.path if "repo" not in p]
try:
    import tripflow
except ModuleNotFoundError:
    pass
else:
    raise SystemExit("tripflow is importable, the check is void")
function = pickle.load(open(sys.argv[1], "rb"))
import pyarrow as pa
rows = next(function(iter([pa.RecordBatch.from_pydict({"path": [sys.argv[2]]})]))).to_pylist()
assert rows[0]["error"] and rows[0]["num_rows"] is None
"""


def test_footer_probe_is_self_contained(tmp_path):
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(footers._probe_batches))
    done = subprocess.run(
        [sys.executable, "-I", "-c", LOADER, str(tmp_path / "f.pkl"), str(tmp_path / "f.pkl")], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
