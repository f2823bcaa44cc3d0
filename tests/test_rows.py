"""What Python holds at a time does not grow with the number of rows, and no page or document costs a batch of its own."""

import pyarrow as pa
import pytest
from helpers import SMALL

from docflow import schemas, udfs
from docflow.plans import QUERIES
from docflow.sources import big_xml

BY_ROWS = ["article_boxes", "article_captions", "article_inline", "article_lists", "article_sections", "citation_cleanup", "front_matter_round_trip", "html_to_markdown", "markdown_escape", "protect_block_start", "table_grid_expand"]


@pytest.mark.parametrize("name", BY_ROWS)
def test_texts_come_a_hundred_at_a_time(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan
    assert "ArrowEvalPython" not in plan


def test_parsed_rows_are_gathered_over_pages_and_leave_in_bounded_batches():
    pages = pa.RecordBatch.from_pydict({"page": [*range(300)], "xml": [b"<x/>"] * 300})
    made = list(udfs._parsed(lambda _: iter([{"pmcid": "1"}, {"pmcid": "2"}]), udfs._columns(f"page long, at long, {schemas.ARTICLES}"))(iter([pages])))
    assert max(b.num_rows for b in made) <= udfs.ROWS
    assert len(made) <= 600 // udfs.ROWS + 1
    rows = [r for b in made for r in b.to_pylist()]
    assert [(r["page"], r["at"], r["pmcid"]) for r in rows] == [(n // 2, n % 2, str(n % 2 + 1)) for n in range(600)]


def test_pieces_of_large_files_are_scanned_in_bounded_batches():
    pieces = pa.RecordBatch.from_pydict({"value": [f"<r>{n}" for n in range(300)], "file": ["f"] * 300, "block": [0] * 300, "at": [*range(300)]})
    made = list(big_xml._scan(iter([pieces])))
    assert max(b.num_rows for b in made) <= big_xml.ROWS
    assert [r["at"] for b in made for r in b.to_pylist()] == [*range(300), None]
