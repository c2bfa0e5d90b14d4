"""Every registered query runs again in the same session: nothing it touches may keep state from the first run."""

import copy

import pytest

from farelens import schemas
from farelens.workload.queries import QUERIES


def declared():
    return {name: copy.deepcopy(value) for name, value in vars(schemas).items() if name.endswith("_SCHEMA")}


AGAIN = ["chunked_landing", "land_raw", "load_twice", "persisted_star", "serving_views", "import_flat_extract"]


@pytest.mark.parametrize("name", AGAIN)
def test_queries_that_write_run_twice(spark, sf_dir, name):
    before = declared()
    counts = {QUERIES[name](spark, sf_dir).count() for _ in range(2)}
    assert len(counts) == 1 and declared() == before


def test_building_a_plan_changes_no_schema(spark, sf_dir):
    """The other queries: building them is enough, as only that could change a schema."""
    before = declared()
    for name in sorted(set(QUERIES) - set(AGAIN)):
        QUERIES[name](spark, sf_dir)
    assert declared() == before
