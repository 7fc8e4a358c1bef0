"""CSV and JSON-dictionary sources on hand-written files."""

import json
import os
import random
import uuid

import pytest

from cardmarts.session import shared_dir
from cardmarts.sources import json_lexer as L
from cardmarts.sources import (
    SourceMissing,
    check_ingest_args,
    read_csv_entity,
    read_json_dictionary,
    read_json_dictionary_whole,
    read_landing,
)
from cardmarts.sources.config import active_tables, read_config


def folder(spark, files: dict[str, str]) -> str:
    root = shared_dir(spark, "tests", uuid.uuid4().hex[:10])
    os.makedirs(root, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)
    return root


def test_csv_scan_positions_short_and_extra_rows(spark):
    header = "a,b,c,d,e,f,g,h,i,j,k,l,m\n"  # names differ from the schema: matched by position
    rows = "1,7,Visa,Credit,4000,01/2025,123,YES,1,$10.50,2002-09-01,2010,No\n"
    rows += "2,8,,Debit\n"  # short row
    rows += "3,9,Amex,Debit,4001,02/2025,456,NO,2,$5.50,2002-09-01,2011,No,EXTRA\n"
    p = folder(spark, {"cards.csv": header + rows})
    got = {r.id: r for r in read_csv_entity(spark, p, "cards").collect()}
    assert got["1"].card_brand == "Visa" and got["1"].card_on_dark_web == "No"
    assert got["2"].card_brand is None and got["2"].card_type == "Debit" and got["2"].cvv is None
    assert got["3"].card_on_dark_web == "No"  # extra field dropped
    assert got["1"]["__source_file"].endswith("cards.csv")


def test_json_dictionary_edge_cases(spark):
    text = '{"target": {"1-1": "Yes", "1-2": null, "1-3": 5, "1-1": "No"}}'
    p = folder(spark, {"labels.json": text})
    for reader in (read_json_dictionary, read_json_dictionary_whole):
        rows = sorted((r.k, r.v) for r in reader(spark, p, "k", "v", "target").collect())
        assert rows == [("1-1", "No"), ("1-1", "Yes"), ("1-2", None), ("1-3", "5")], reader.__name__


def test_json_dictionary_escapes_and_flat(spark):
    text = '{"A\\"1": "x\\u00e9y", "B": "plain", "C": true}'
    p = folder(spark, {"codes.json": text})
    for reader in (read_json_dictionary, read_json_dictionary_whole):
        rows = sorted((r.k, r.v) for r in reader(spark, p, "k", "v").collect())
        assert rows == [('A"1', "xéy"), ("B", "plain"), ("C", "true")], reader.__name__


def test_json_dictionary_empty_and_truncated(spark):
    p = folder(spark, {"empty.json": '{"target": {}}'})
    assert read_json_dictionary_whole(spark, p, "k", "v", "target").count() == 0
    assert read_json_dictionary(spark, p, "k", "v", "target").count() == 0
    for text in ('{"target": {"1-1": "Yes", "1-2":', '{"target": {"1-1": "Yes", "1-2": "No"', '{"target": {"1-1": "Yes", "1-2" "No"}}', '{"other": {"a": "b"}}', "[1]"):
        bad = folder(spark, {"bad.json": text})
        for reader in (read_json_dictionary, read_json_dictionary_whole):
            with pytest.raises(Exception, match="Malformed|without its member|in pieces"):
                reader(spark, bad, "k", "v", "target").collect()


def test_a_file_that_breaks_off_inside_a_string_is_not_published(spark):
    from cardmarts.plans.run import Lake, ingest_entity

    root = shared_dir(spark, "tests", "torn-" + uuid.uuid4().hex[:8])
    d = os.path.join(root, "fraud_labels", "ingestion_date=2024-05-01")
    os.makedirs(d)
    lake = Lake(shared_dir(spark, "tests", "torn-lake-" + uuid.uuid4().hex[:8]))
    for name, text in (("a", '{"target": {"1-1": "Yes"}}'), ("b", '{"target": {"2-1": "Yes", "2-2": "N')):
        with open(os.path.join(d, f"{name}.json"), "w") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="inside a string"):
        ingest_entity(spark, lake, root, "fraud_labels", "2024-05-01", log=False)
    with pytest.raises(FileNotFoundError):
        lake.read(spark, "bronze", "fraud_labels")
    with open(os.path.join(d, "b.json"), "w") as fh:
        fh.write('{"target": {"2-1": "Yes", "2-2": "No"}}')
    assert ingest_entity(spark, lake, root, "fraud_labels", "2024-05-01", log=False).rows == 3


DICTIONARIES = {
    "commas": '{"5411": "Grocery, Supermarkets", "5812": "Eating, \\"fast\\" Places", "a,b": ", x"}',
    "blanks": '\n{\t"1" :\t"Yes",\n"2"\r\n:\r\n"No" , "3":\tnull,"4"\n: 7.50,"5":true}\n',
    "escapes": '{"q\\u0041": "back\\\\slash", "brace": "}{", "x": "a\\nb", "x": "again"}',
    "empty": "{ }",
    "numbers": '{"a": 1, "b": -2.5, "c": 3}',
}


@pytest.mark.parametrize("name", [k for k in DICTIONARIES if k != "commas"])
@pytest.mark.parametrize("nested", [False, True])
def test_split_and_whole_readers_agree(spark, name, nested):
    text = DICTIONARIES[name]
    text = f'{{"version": 3, "target": {text}, "note": "end"}}' if nested else text
    p = folder(spark, {"d.json": text})
    rows = [sorted((r.k, r.v or "") for r in reader(spark, p, "k", "v", "target" if nested else None).collect())
            for reader in (read_json_dictionary, read_json_dictionary_whole)]
    assert rows[0] == rows[1]
    assert len(rows[0]) == {"blanks": 5, "escapes": 4, "empty": 0, "numbers": 3}[name]


def test_commas_inside_values(spark):
    p = folder(spark, {"d.json": '{"5411": "Grocery, Supermarkets", "5812": "Eating Places, Bars"}'})
    rows = sorted((r.k, r.v) for r in read_json_dictionary(spark, p, "k", "v").collect())
    assert rows == [("5411", "Grocery, Supermarkets"), ("5812", "Eating Places, Bars")]


def both_readers(spark, p, root):
    return [sorted((r.k, r.v or "") for r in reader(spark, p, "k", "v", root).collect()) for reader in (read_json_dictionary, read_json_dictionary_whole)]


@pytest.mark.parametrize("text", [
    DICTIONARIES["commas"],  # a value that begins with a comma
    '{"a": "x\\", y", "b": "z"}',  # an escaped quote before a comma
    '{"first": "x", "target": {"1": "Yes", "2": "No"}}',  # a string member before the root
    '{"target": {"1": "Yes", "2": "No"}, "x": "y", "z": "w"}',  # and after it
    '{"target": {"1": "Yes"}, "m": {"a": "x", "b": "y"}}',  # a second dictionary after it
    '{"m": {"a": "x", "target": "y"}, "target": {"1": "Yes"}}',
    '{"target": {"1": "Yes", "2": ["a", "b"], "3": {"target": {"x": "y", "z": "w"}}}}',
    '\ufeff{"target": {"1": "Yes", "2": "No"}}',  # a byte-order mark
])
def test_legal_dictionaries_read_alike(spark, text):
    p = folder(spark, {"d.json": text})
    split, whole = both_readers(spark, p, "target" if "target" in text else None)
    assert split == whole and whole


@pytest.mark.parametrize("text", [
    '{"target": {"1":"Yes","2":"N', '{"target": {"1":"Yes",', '{"target": {"1":"Yes","2":"No"}', '{"target": {"1":"Yes"}} {"target": {"2":"No"}}',
    '{"target": {"1":"Yes"}} x', '{"target": {"1":"Yes",}}', '{"target": {"1":"Yes"}, "target": {"2":"No"}}', "  ", '{"target": 5}',
])
def test_broken_files_fail_in_both_readers(spark, text):
    p = folder(spark, {"good.json": '{"target": {"0": "Yes"}}', "bad.json": text})
    for reader in (read_json_dictionary, read_json_dictionary_whole):
        with pytest.raises(Exception, match="Malformed|without its member"):
            reader(spark, p, "k", "v", "target").collect()


def test_lexer_in_random_splits():
    """Random documents, split at random separators and chunk sizes, give the parser's members; cut-off ones fail."""
    rng = random.Random(5)

    def value(depth=0):
        r = rng.random()
        if r < 0.5:
            return "".join(rng.choice(['a', '"', ",", "\\", "{", "}", " "]) for _ in range(rng.randint(0, 6)))
        if r < 0.6 or depth == 2:
            return rng.choice([None, True, rng.randint(0, 99)])
        if r < 0.8:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        return {f'k",{k}': value(depth + 1) for k in range(rng.randint(0, 3))}

    def read(text, root):
        lines, splits = text.split(L.SEPARATOR), [[]]
        for line in lines:
            splits[-1].append(line)
            if rng.random() < 0.4:
                splits.append([])
        splits = [x for x in splits if x]
        sums = []
        for k, own in enumerate(splits):
            summary = L.Summary(root)
            for part in L.chunks(own, False):
                summary.add(part)
            sums.append((k, summary.pack()))
        whole, pieces = [], []
        for (k, state, torn), own in zip(L.compose("f", root, sums), splits, strict=True):
            cutter = L.Cutter("f", state, root)
            for kind, found in [x for part in L.chunks(own, cutter.more) for x in cutter.add(part)] + list(cutter.close()):
                assert kind == "whole" or torn
                whole.append(found) if kind == "whole" else pieces.append((k, kind, found))
        return sorted((k, json.dumps(v)) for t in whole + L.stitch(pieces) for k, v in json.loads(b"{" + t + b"}").items())

    for _ in range(1_500):
        members = {f'{rng.choice(["", ",", chr(34)])}{k}': value() for k in range(rng.randint(0, 6))}
        root = rng.choice([None, "target"])
        beside = {f"b{k}": value() for k in range(rng.randint(0, 2))}
        document = members if root is None else {**beside, "target": members, **{f"z{k}": value() for k in range(rng.randint(0, 2))}}
        text = json.dumps(document, indent=rng.choice([None, 1]), separators=rng.choice([(",", ":"), (", ", ": ")])).encode()
        assert read(text, root) == sorted((k, json.dumps(v)) for k, v in members.items())
        torn = text[: rng.randint(1, len(text) - 1)]
        with pytest.raises((L.BrokenJson, json.JSONDecodeError)):
            read(torn, root)


def test_splits_give_the_same_rows_without_shuffling_text(spark):
    hard = ['"v, {}"', '",{}"', '"a\\",{}"', '{{"x": "y", "n": [{}, "z"]}}', "{}", '"' + "long \\\",text, " * 900 + '{}"']
    pairs = ", ".join(f'"{i}"{" " * (i % 3)}:{chr(10) * (i % 2)}{chr(9)}{hard[5 if i % 400 == 7 else i % 5].format(i)}' for i in range(4000))
    p = folder(spark, {"d.json": '{"first": "x", "target": {' + pairs + '}, "last": "y", "end": "z"}', "e.json": '{"target": {"e": "f"}}'})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = read_json_dictionary(spark, p, "k", "v", "target")
        assert df.rdd.getNumPartitions() > 5
        split, whole = both_readers(spark, p, "target")
        assert split == whole and len(split) == 4001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_reader_requires_files(spark):
    p = folder(spark, {"notes.txt": "nothing"})
    with pytest.raises(SourceMissing):
        read_json_dictionary(spark, p, "k", "v")


def test_landing_presence_and_allow_lists(spark):
    root = shared_dir(spark, "tests", "no-landing-" + uuid.uuid4().hex[:8])
    with pytest.raises(SourceMissing):
        read_landing(spark, root, "users", "2024-01-01")
    with pytest.raises(ValueError):
        check_ingest_args("accounts")
    with pytest.raises(ValueError):
        check_ingest_args("users", "xml")
    with pytest.raises(ValueError):
        check_ingest_args("users", "json")


def test_landing_lineage_columns(spark):
    root = shared_dir(spark, "tests", "landing-" + uuid.uuid4().hex[:8])
    d = os.path.join(root, "mcc_codes", "ingestion_date=2024-03-01")
    os.makedirs(d)
    with open(os.path.join(d, "mcc.json"), "w") as fh:
        fh.write('{"5411": "Grocery Stores", "5812": "Eating Places"}')
    df = read_landing(spark, root, "mcc_codes", "2024-03-01", "json")
    assert df.columns == ["mcc_code", "mcc_description", "_ingested_at", "_ingestion_date",
                          "_source_file", "_batch_id"]
    r = df.orderBy("mcc_code").first()
    assert (r.mcc_code, r._ingestion_date, r._batch_id) == ("5411", "2024-03-01", "mcc_codes_2024-03-01")
    assert r._source_file.endswith("mcc.json")


def test_config_active_filter(spark):
    assert active_tables(spark, "bronze") == ["transactions", "users", "cards", "mcc_codes", "fraud_labels"]
    assert len(active_tables(spark, "gold")) == 4
    p = folder(spark, {"silver_tables.json": '[{"silver_table": "dim_mcc", "bronze_source": ["mcc_codes"], '
                                      '"is_active": false}, {"silver_table": "dim_card", '
                                      '"bronze_source": ["cards"], "is_active": true}]'})
    assert active_tables(spark, "silver", p) == ["dim_card"]
    assert read_config(spark, "silver", os.path.join(p, "silver_tables.json")).count() == 2


def test_json_dictionary_pretty_printed(spark):
    text = '{\n  "target": {\n    "10-1": "Yes",\n    "10-2": "No",\n    "10-3": -1.5e3\n  }\n}\n'
    p = folder(spark, {"labels.json": text})
    for reader in (read_json_dictionary, read_json_dictionary_whole):
        rows = sorted((r.k, r.v) for r in reader(spark, p, "k", "v", "target").collect())
        # numbers keep from_json's text form in both readers
        assert rows == [("10-1", "Yes"), ("10-2", "No"), ("10-3", "-1500.0")], reader.__name__
