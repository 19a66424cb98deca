"""Records of several lines, stray quotes and the splits of a file, against a plain walk along the lines."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from oreflow.contracts import ORDERS
from oreflow.errors import IngestionError
from oreflow.operators.validate import bad_rows, good_rows
from oreflow.session import stored_once
from oreflow.sources.landing import ORDINAL, read_orders
from oreflow.sources.records import any_leaves_open, records, text_lines

HEADER = "order_id,customer_id,product_id,order_date,quantity,unit_price,status\n"
TAIL = "P,2025-01-01,1,2.0,shipped"


def walk(text, inside):
    """(commas between fields, state at the end) of a line; None if a value is closed before other text."""
    commas, k, field_start = 0, 0, not inside
    while k < len(text):
        if inside:
            end = re.compile(r'(?:[^"]|"")*"(?!")').match(text, k)
            if not end:
                return commas, True
            k, inside, field_start = end.end(), False, False
            if k < len(text) and text[k] != ",":
                return None
        elif field_start and text[k] == '"':
            end = re.compile(r'"(?:[^"]|"")*"(?!")[^,]*').match(text, k)
            if not end:
                return commas, True
            k, field_start = end.end(), False
        else:
            field_start = text[k] == ","
            commas += field_start
            k += 1
    return commas, inside


def plain(lines, fields):
    out, k = [], 0
    while k < len(lines):
        commas, open_ = walk(lines[k], False)
        end = None
        if open_:
            for j in range(k + 1, len(lines)):
                found = walk(lines[j], True)
                if found is None:
                    break
                commas += found[0] if '"' in lines[j] else 0
                if not found[1]:
                    end = j if commas == fields - 1 else None
                    break
        out.append("\n".join(lines[k : (end or k) + 1]))
        k = (end or k) + 1
    return [r for r in out if r.strip()]


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def made(draw, n):
    rows = []
    for k in range(n):
        kind = draw.randrange(8)
        middle = {
            0: '"two\nlines"', 1: '"a ""quoted"" word,\n\n,and ""more"""', 2: f'"{"long, " * 30}\n{"text" * 60}\nend"',
            3: '"one line, only"', 4: '""', 5: "plain", 6: '5" pipe', 7: '"never closed',
        }[kind]
        rows.append((f"O{k}", kind, f"O{k},{middle},{TAIL}"))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_records_equal_a_walk_over_many_splits(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    whole = []
    for f in range(3):
        text = HEADER + "\n".join(r for _, _, r in made(draw, 60)) + "\n"
        (tmp_path / f"part-{f}.csv").write_text(text)
        whole += plain(text.split("\n")[1:], 7)
    lines = text_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 12 and any_leaves_open(lines)
    got = records(stored_once(lines, "lines"), 7).collect()
    assert sorted(r.value for r in got) == sorted(whole)
    assert len({(r.path, r.block, r.at) for r in got}) == len(got)


def test_orders_with_quoted_line_ends_and_stray_quotes(spark, tmp_path, small_splits):
    rows = made(random.Random(9), 200)
    (tmp_path / "orders_2025-01-01.csv").write_text(HEADER + "\n".join(r for _, _, r in rows) + "\n")
    read = read_orders(spark, str(tmp_path), "2025-01-01", "now")
    good = {r.order_id: r.customer_id for r in good_rows(read, ORDERS).collect()}
    assert set(good) == {i for i, kind, _ in rows if kind not in (4, 7)}
    assert {good[i] for i, kind, _ in rows if kind == 1} == {'a "quoted" word,\n\n,and "more"'}
    bad = {r.order_id: r._quarantine_reason for r in bad_rows(read, ORDERS).collect()}
    assert set(bad) == {i for i, kind, _ in rows if kind in (4, 7)}
    assert all(bad[i].startswith("row: more or fewer") for i, kind, _ in rows if kind == 7)
    in_file = [r.order_id for r in read.orderBy(F.col(ORDINAL)).collect()]
    assert in_file == [i for i, _, _ in rows]


def test_one_stray_quote_at_the_begin_costs_one_row(spark, tmp_path):
    lines = [f"O{k},C,{TAIL}" for k in range(6)]
    lines[0] = f'O0,"C,{TAIL}'
    (tmp_path / "orders_2025-01-01.csv").write_text(HEADER + "\n".join(lines) + "\n")
    read = read_orders(spark, str(tmp_path), "2025-01-01", "now")
    assert (good_rows(read, ORDERS).count(), bad_rows(read, ORDERS).count()) == (5, 1)


@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_line_ends_byte_order_mark_and_empty_files(spark, tmp_path, end):
    (tmp_path / "orders_2025-01-01.csv").mkdir()
    text = HEADER + f'O1,"a\nb",{TAIL}\n\n  \nO2,C,{TAIL}'
    (tmp_path / "orders_2025-01-01.csv/a.csv").write_bytes(("﻿" + text).replace("\n", end).encode())
    (tmp_path / "orders_2025-01-01.csv/b.csv").write_bytes(HEADER.replace("\n", end).encode())
    (tmp_path / "orders_2025-01-01.csv/c.csv").write_bytes(b"")
    read = read_orders(spark, str(tmp_path), "2025-01-01", "now")
    assert sorted((r.order_id, r.customer_id) for r in read.collect()) == [("O1", "a\nb"), ("O2", "C")]


def test_other_header_beside_quoted_line_ends(spark, tmp_path):
    (tmp_path / "orders_2025-01-01.csv").mkdir()
    (tmp_path / "orders_2025-01-01.csv/a.csv").write_text(HEADER + f'O1,"a\nb",{TAIL}\n')
    (tmp_path / "orders_2025-01-01.csv/b.csv").write_text(",".join(reversed(HEADER.strip().split(","))) + "\n")
    with pytest.raises(IngestionError, match="header"):
        read_orders(spark, str(tmp_path), "2025-01-01", "now")


def test_lines_move_once_and_by_number(spark, tmp_path, small_splits):
    """No sort of whole lines in the look for open quotes, and no shuffle of lines in what reads the stored records."""
    rows = made(random.Random(4), 120)
    (tmp_path / "orders.csv").write_text(HEADER + "\n".join(r for _, _, r in rows) + "\n")
    plan = str(records(stored_once(text_lines(spark, str(tmp_path)), "lines"), 7)._jdf.queryExecution().sparkPlan())
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_header_that_only_a_later_file_has(spark, tmp_path):
    (tmp_path / "orders_2025-01-01.csv").mkdir()
    for name in "abc":
        (tmp_path / f"orders_2025-01-01.csv/{name}.csv").write_text(HEADER + f'O{name},"x\ny",{TAIL}\n' + HEADER)
    path = str(tmp_path / "orders_2025-01-01.csv")
    assert any_leaves_open(text_lines(spark, path))
    (tmp_path / "orders_2025-01-01.csv/c.csv").write_text("a,b\n" + HEADER + f"O1,C,{TAIL}\n")
    with pytest.raises(IngestionError, match=r"header: \['.*\.csv', '.*\.csv'\]"):
        any_leaves_open(text_lines(spark, path))
