"""Sorted streams of groups."""

import pyarrow as pa
import pytest

from trialweave.llm.kit import sorted_groups


def batch(*keys):
    return pa.RecordBatch.from_pydict({"k": pa.array(keys, pa.int64()), "v": pa.array(range(len(keys)), pa.int64())})


@pytest.mark.parametrize(
    "batches",
    [
        [(1, 1, 2), (2, 2), (2, 3)],  # a group over three batches
        [(1, 2), (2, 2), (2, 2), (2, 2), (3,), (4, 4)],
        [(1, 1, 2), (2, 2, 2)],  # a last batch inside the group before
        [(1,), (), (1,)],
    ],
)
@pytest.mark.parametrize("most", [1, 40, 1 << 20])
def test_groups_are_whole_and_no_row_is_lost(batches, most):
    tables = [t.column("k").to_pylist() for t in sorted_groups((batch(*b) for b in batches), "k", most)]
    assert [k for t in tables for k in t] == [k for b in batches for k in b]
    assert all(tables) and all(a[-1] != b[0] for a, b in zip(tables, tables[1:]))
