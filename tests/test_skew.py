"""The same queries over split files in which one key, source or text holds a third of all rows."""

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lodestrata.plans.catalogue import QUERIES
from lodestrata.plans.oracles import ORACLES
from tests.conftest import SF
from tests.test_queries import TABLES, rows


def skewed(name, frame):
    n = len(frame) // 3
    if name == "documents":  # copies of one text in one source
        frame.loc[:n, ["text", "source", "lang"]] = [frame["text"][5], "src0", "en"]
    elif name == "conversations":  # one long conversation
        hot = frame.iloc[: n + 1].assign(conv_id=10**6, turn=range(n + 1))
        frame = pd.concat([frame[frame["conv_id"] > frame["conv_id"][n]], hot])
    elif name == "embeddings":  # copies of one vector
        for i in range(n):
            frame.at[i, "embedding"] = frame.at[0, "embedding"]
    return frame.sample(frac=1, random_state=3)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("skew")
    for t in TABLES:
        table = pq.read_table(f"{SF}/{t}.parquet")
        frame = skewed(t, table.to_pandas())
        (base / f"{t}.parquet").mkdir()
        step = -(-len(frame) // 3)
        for i in range(3):
            part = pa.Table.from_pandas(frame.iloc[i * step : (i + 1) * step], schema=table.schema, preserve_index=False)
            pq.write_table(part, base / f"{t}.parquet" / f"part-{i}.parquet")
    return str(base)


NAMES = [
    "chunks", "chunk_ids", "docs_without_chunks", "topk_cosine", "index_snapshot", "index_sync", "stream_chunks", "stream_index",
    "history_pairs", "history_nested", "current_question", "rag_inputs", "format_hits", "split_full", "token_f1", "eval_grid",
    "demo_select", "leaderboard", "promote_alias",
]


@pytest.mark.parametrize("name", NAMES)
def test_skewed(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = QUERIES[name](spark, folder).toArrow().to_pandas()
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(con.execute(ORACLES[name]).fetchdf(), columns)
