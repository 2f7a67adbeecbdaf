"""Licence recognition."""

import pytest

from creditgrade.llm import licenses

CASES = {
    None: ("", ""),
    "": ("", ""),
    "Nothing here.": ("", ""),
    "Released under the MIT License.": ("MitNotice", "MIT"),
    "x\nLicensed under the Apache License, Version 2.0.\ny": ("ApacheNotice", "Apache-2.0"),
    "Licensed under CC BY-NC 4.0.": ("CcByNc", "CC-BY-NC-4.0"),
    "The software is provided as is.": ("AsIs", "UNKNOWN"),
    "Redistribution and use in source and binary forms are permitted. Neither the name of X "
    "nor the names of its contributors may be used.": ("BsdRedistribution,BsdEndorse", "BSD-3-Clause"),
    "Redistribution and use in source and binary forms.": ("BsdRedistribution", "BSD-2-Clause"),
    "MIT License": ("", ""),
    "Released under the MIT License. Licensed under CC BY 4.0!": ("MitNotice,CcBy", "CC-BY-4.0,MIT"),
    "z " * 200_000 + "\r\nReleased under the MIT License.": ("MitNotice", "MIT"),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(text, "clash") for text in CASES]
    docs = spark.createDataFrame(rows, "text string, licences string")
    return licenses.with_licences(docs, "text")


def test_cases(found):
    rows = {r["text"]: (",".join(r["sentence_ids"]), ",".join(r["licences"])) for r in found.collect()}
    assert rows == CASES


def test_empty_table(found):
    assert found.columns == ["text", "sentence_ids", "licences"]
    assert found.limit(0).count() == 0
