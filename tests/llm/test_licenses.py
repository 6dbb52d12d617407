"""License labels that are there, and such as are not."""

import duckdb
import pytest

from coldshelf.llm import licenses
from coldshelf.llm.queries import ORACLE
from compare import oracle_rows, spark_rows

# A text and the labels that it deserves.
CASES = [
    ("Licensed under CC BY 4.0", "cc-by,cc-by-4.0"),
    ("The pictures are licensed under CC BY-NC 4.0 by the author.", "cc-by,cc-by-nc-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by,cc-by-sa-4.0"),
    ("This work is licensed under the GNU General Public License, version 2", "gpl,gpl-2.0"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl,gpl-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3", "gpl,lgpl-3.0"),
    (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation",
        "gpl,lgpl",
    ),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution International License.", "cc-by"),
    ("Released under the MIT License", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("Licensed under the Apache License, Version 1.1", ""),
    ("the book was released under the old license of the town", ""),
    ("it was licensed under the new rules of 4 by 4 cars", ""),
    ("All rights reserved. No part of this publication may be reproduced without permission of the publisher", "reserved"),
    (None, ""),
    ("", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(i, t) for i, (t, _) in enumerate(CASES)] + [(100 + i, f"{long} {t} {long}") for i, (t, _) in enumerate(CASES) if t]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_labels_are_true(docs):
    found = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    for i, (text, labels) in enumerate(CASES):
        assert found[i] == labels, text
        if text:
            assert found[100 + i] == labels, f"inside a long text: {text}"


def test_sql_says_the_same(docs):
    connection = duckdb.connect()
    connection.register("documents", docs.toArrow())
    assert spark_rows(licenses.scan(docs)) == oracle_rows(connection, ORACLE["op3_licenses"])


def test_no_python_in_the_plan(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
