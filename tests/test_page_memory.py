"""Pages are parsed once, one at a time."""

import gc
import weakref

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.functions import dom
from ledgerloom.plans import nested_plans
from ledgerloom.sources import files


def test_one_parse_for_an_exploded_part(spark):
    rows = spark.createDataFrame([("<a href=x>y</a>",)], "h string").select(dom.page_parts("links")("h")["links"].alias("p")).select(F.explode("p").alias("l"))
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r.l.href for r in rows.collect()] == ["x"]


def test_one_page_is_held_at_a_time(monkeypatch):
    alive, most = weakref.WeakSet(), []

    class Watched(dom.Page):
        def __init__(self, *args):
            alive.add(self)
            most.append(len(alive))
            super().__init__(*args)

    monkeypatch.setattr(dom, "Page", Watched)
    gc.collect()
    got = dom.page_parts("birth_days", "h1").func(pa.array([f"<h1>{i}</h1><p class=bday>1 May {i}</p>" for i in range(200)] + [None]))
    assert max(most) <= 2 and len(got) == 201
    assert got[150].as_py() == {"birth_days": ["1 May 150"], "h1": "150"} and got[200].as_py() == {"birth_days": [], "h1": None}


def test_page_files_are_packed_and_read_by_one_worker(spark):
    rows = nested_plans.src_html_pages(spark, "/root/testdata/sf0.001")
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_large_batches_of_files_leave_in_pieces():
    texts = ["é" * 700_000, None, "", "x" * 3_000_000, "y"]
    packed = files.gzipped.func(pa.array(texts))
    assert [v.as_py() for v in files.decompress.func(packed)] == [t if t is None else t.encode() for t in texts]
    assert len(files.decompress.func(pa.array([], pa.binary()))) == 0
    assert files.decompress.func(pa.array([b"\x1f\x8bdamaged", b"plain"])).to_pylist() == [None, b"plain"]
