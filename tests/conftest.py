import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = os.environ.get("CARLOT_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from carlot.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="carlot-tests",
                    checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")), driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_catalog(spark):
    from carlot.sources.catalog import load_make_catalog
    return load_make_catalog(spark, os.path.join(FIXTURES, "catalog_small.json"))


@pytest.fixture(scope="session")
def small_generations(spark):
    from carlot.sources.catalog import load_generation_catalog
    return load_generation_catalog(spark, os.path.join(FIXTURES, "generations_small.json"))
