"""Whole licence texts beyond MIT and ISC."""

from __future__ import annotations

from shelfmark.llm import licenses

SHORT = ["BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "ISC", "MIT", "Unlicense", "Zlib"]


def test_short_licences_by_whole_text(spark):
    assert sorted(licenses.TEXTS) == SHORT
    texts = [f"Copyright (c) 2020 Someone\nAll rights reserved.\n\n{licenses.TEXTS[n]}\n" for n in SHORT]
    texts += [f"{licenses.NAMES[n]}\n\n{licenses.TEXTS[n]}" for n in SHORT]
    texts += [licenses.TEXTS["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ").replace("HOLDER OR", "OWNER OR"),
              "Boost Software License - Version 1.0 - August 17th, 2003\n\n" + licenses.TEXTS["BSL-1.0"]]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), licenses.known_digests(spark)).orderBy("doc_id").collect()
    assert [r["license"] for r in rows] == [*SHORT, *SHORT, "BSD-3-Clause", "BSL-1.0"]
