import pandas as pd

SF_DIR = "/root/testdata/sf0.001"


def table(name, sf_dir=SF_DIR):
    return pd.read_parquet(f"{sf_dir}/{name}.parquet")


def pairs(frame, key="doc_id", text="text"):
    return list(zip(frame[key].tolist(), frame[text].tolist()))


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def rows_by(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
