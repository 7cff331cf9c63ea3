"""File sources: text, whole files, CSV with and without header, JSON with bad lines."""

import os

from pyspark.sql import types as T

from tessera.sources import files as S


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_text_and_whole_files(spark, tmp):
    write(os.path.join(tmp, "a.txt"), "one\ntwo\n")
    write(os.path.join(tmp, "b.txt"), "three\n  four\n")
    assert S.read_lines(spark, tmp).count() == 4
    whole = {os.path.basename(r["path"]): r["text"] for r in S.read_whole_files(spark, tmp).collect()}
    assert whole == {"a.txt": "one\ntwo\n", "b.txt": "three\n  four\n"}


def test_csv(spark, tmp):
    p = os.path.join(tmp, "carriers.csv")
    write(p, "Code,Description\nAS,Alaska\nUA,United\n")
    df = S.read_csv(spark, p, header=True, infer=True)
    assert df.columns == ["Code", "Description"] and df.count() == 2
    p2 = os.path.join(tmp, "posts.csv")
    write(p2, '0,1,Mon,q,u1,"bad day"\n4,2,Tue,q,u2,"good day"\n')
    df = S.read_csv(spark, p2, header=False, infer=True,
                    names=["polarity", "id", "date", "query", "user", "tweet"])
    assert dict(df.dtypes)["polarity"] == "int"
    assert sorted(r["tweet"] for r in df.collect()) == ["bad day", "good day"]


def test_json_corrupt(spark, tmp):
    p = os.path.join(tmp, "c.json")
    write(p, '{"Code": "AS", "Description": "Alaska"}\n{"Code": "UA"\n{"Code": "DL", "Description": "Delta"}\n')
    df = S.read_json_lines(spark, p)
    assert "_corrupt_record" in df.columns
    good, bad = S.split_corrupt(df)
    assert sorted(r["Code"] for r in good.collect()) == ["AS", "DL"]
    assert [r["_corrupt_record"] for r in bad.collect()] == ['{"Code": "UA"']
    schema = T.StructType([T.StructField("Code", T.StringType()), T.StructField("Description", T.StringType())])
    good, bad = S.split_corrupt(S.read_json_lines(spark, p, schema))
    assert good.count() == 2 and bad.count() == 1
