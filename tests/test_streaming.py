"""The streaming ingest produces the same tables as the batch runs."""

import os

from flightlines import write_csv
from test_monthly import FEBRUARY, JANUARY, STRAGGLER, lines

from tarmac import schema as S
from tarmac.plans.monthly import run_month, table
from tarmac.streaming import start_ingest


def ingest(spark, scratch, **kw):
    seen = []
    query = start_ingest(spark, f"{scratch}/landing", f"{scratch}/stream", on_batch=lambda e, r: seen.append(r), **kw)
    query.awaitTermination(300)
    return seen


def flights_in(spark, root):
    return sorted(map(tuple, table(spark, root, "fct_flights").collect()), key=str)


def test_files_arrive_one_after_another(spark, scratch):
    os.makedirs(f"{scratch}/landing")
    wide = ["Quarter", *sorted(S.RAW_COLUMNS), "Tail_Number"]
    files = {
        "01.csv": (JANUARY[:47], None),
        "02.csv": (FEBRUARY + STRAGGLER, wide),  # more columns, another order, a row of January
        "03.csv": (["HA/1 HNL- 2021-03-01"], None),  # no usable row
        "04.csv": (JANUARY[47:] + lines("2021-03", range(3)), None),
    }
    got = []
    for name, (rows, columns) in files.items():
        write_csv(f"{scratch}/landing/{name}", rows, columns)
        got += ingest(spark, scratch)
    assert [(r.clean_rows, r.months) for r in got] == [
        (47, [(2021, 1)]), (51, [(2021, 1), (2021, 2)]), (0, []), (6, [(2021, 1), (2021, 3)]),
    ]
    assert ingest(spark, scratch) == []  # nothing new: the checkpoint under the root remembers
    for name in ("01.csv", "02.csv", "04.csv"):
        run_month(spark, f"{scratch}/landing/{name}", f"{scratch}/batch")
    assert flights_in(spark, f"{scratch}/stream") == flights_in(spark, f"{scratch}/batch")


def test_options_reach_the_run_and_bad_files_are_reported(spark, scratch):
    os.makedirs(f"{scratch}/landing")
    write_csv(f"{scratch}/landing/twice.csv", JANUARY + JANUARY)
    write_csv(f"{scratch}/landing/bad.csv", JANUARY, S.RAW_COLUMNS[:-1])
    errors = []
    seen = ingest(
        spark, scratch, dedupe_keys=True, salt_buckets=2, max_files_per_trigger=1,
        on_error=lambda epoch, path, error: errors.append(os.path.basename(path)),
    )
    assert errors == ["bad.csv"] and [r.clean_rows for r in seen] == [100]
    assert len(flights_in(spark, f"{scratch}/stream")) == 50
