"""Chart-wise sinks: every chart is written, in the format of the query's name."""

import csv
import glob
import json
import os

import pytest

from folioframe.plans import base, catalog, surface

SF = os.environ.get("FOLIO_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.mark.parametrize("name, fmt", [("sink_csv_per_chart", "csv"), ("sink_staging_json", "json")])
def test_all_charts_in_their_format(spark, tmp_path, monkeypatch, name, fmt):
    at = str(tmp_path / "out")
    monkeypatch.setattr(surface, "_scratch", lambda spark: at)
    catalog.queries()[name](spark, SF)
    found = set()
    for path in glob.glob(f"{at}/chart=*/*.{fmt}"):
        chart = int(os.path.basename(os.path.dirname(path)).split("=")[1])
        with open(path) as f:
            rows = csv.DictReader(f) if fmt == "csv" else map(json.loads, f)
            found |= {(chart, int(r["page_no"]), r["kind"]) for r in rows}
    assert found == {(r.chart, r.page_no, r.kind) for r in base.order_pages(spark, SF).select("chart", "page_no", "kind").collect()}
