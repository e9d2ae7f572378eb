"""Which records are over several lines."""

from __future__ import annotations

import pytest

from tallyroll.contracts import SOURCES
from tallyroll.session import scratch_path
from tallyroll.sources.delimited import inspect_text
from tallyroll.sources.files import Files


@pytest.mark.parametrize(
    ("record", "several"),
    [('1,"",2', False), ('"",""', False), ('1,"""",2', False), ('1,a""b,2', False), ('1,"a ""b"" c",2', False), ('1,6" nail,2', False),
     ('1,"open', True), ('1,"""open', True), ('1,"","open ""x""', True)],
)
def test_only_records_that_stay_open_are_over_several_lines(spark, record, several):
    folder = scratch_path(spark, "quotes")
    contract = SOURCES[0]
    Files(spark).replace_text(f"{folder}/{contract.file_name}", f"{','.join(contract.headers)}\n{record}\n", "new")
    assert bool(inspect_text(spark, folder, contract).multiline_files) is several
