"""The entry module and the session outside this suite's own session."""
import os
import subprocess
import sys
import tempfile

from feedlens.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, **env):
    out = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(prefix="feedlens-run-"), capture_output=True,
                         text=True, env=os.environ | {"PYTHONPATH": ROOT} | env, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.strip().splitlines()


BLOCKED = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == {name!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), set(e.queries()) == set(e.oracle_sql()))
"""


def test_missing_packages_of_the_optional_part_leave_the_analytics():
    for name in ("xxhash", "corpus_pipeline"):
        assert run(BLOCKED.format(name=name)) == [f"{len(catalog.registry())} True"]


def test_session_without_any_configuration():
    """No checkpoint folder is configured: local runs make one of their own."""
    code = """
from feedlens.session import build_session, ensure_checkpoint_dir
from feedlens.plans import catalog
s = build_session('local[2]', 2)
for name in ('ab_test_03', 'ctr_histogram', 'aa_split_check', 'active_users_7d'):
    print(name, catalog.registry()[name](s, '/root/testdata/sf0.001').count() > 0)
assert ensure_checkpoint_dir(s) == ensure_checkpoint_dir(s)
"""
    empty = tempfile.mkdtemp(prefix="feedlens-conf-")
    out = run(code, SPARK_CONF_DIR=empty)
    assert [x for x in out if x.endswith(" True")] == [
        f"{n} True" for n in ("ab_test_03", "ctr_histogram", "aa_split_check", "active_users_7d")]
