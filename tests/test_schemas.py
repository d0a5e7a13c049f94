"""Schemas as rows: checks of many schemas are those of each schema alone, and the plan does not grow with them."""

import random

from feedcheck.functions.dialect import dialect
from feedcheck.operators.schemas import distinct_cells, parse_group, places
from feedcheck.functions.schema import FeedField, FeedSchema
from feedcheck.plans.feeds import avro_schema
from feedcheck.plans.validation import validate_files
from feedcheck.sources.lines import ordered_lines

FORM = dialect(sep="|")
SETTINGS = {
    "header_record_count": "1", "footer_record_count": "0", "record_count_location": "header_metadata", "metadata_header_record": "1",
    "add_file_and_record_id": "1", "file_uuid_or_id": "file_uuid", "field_separator": "|", "file_uuid": "u-1",
}
KINDS = [("long",), ("int?",), ("string",), ("string?",), ("double",), ("boolean?",), ("long", "yyyyMMdd", "date"), ("string?", "dd.MM.yyyy", "date"), ("int", None, "date"), ("long", "YYYY", "date")]
TEXTS = ["", "1", "7", "2.5", "true", "20240131", "31.01.2024", "null", "x", "12345678901"]


def _files(n, seed):
    """Files of one to four fields of any kind, with a header line of the known fields in any order."""
    draw = random.Random(seed)
    out = []
    for k in range(n):
        fields = [(f"f{i}", *draw.choice(KINDS[:6] if draw.random() < 0.7 else KINDS)) for i in range(draw.randint(1, 4))]
        target = [("record_id", "long"), ("f1", "string"), ("absent", "string?"), ("f0", "string")][: draw.randint(1, 4)]
        known = draw.sample([("record_count", "long"), ("Record_Count", "long"), ("file_size", "long"), ("data_start_date", "string", "dd/MM/yyyy"), ("note", "string")], draw.randint(1, 4))
        rows = []
        for _ in range(3):
            easy = [{"l": "1", "i": "7", "s": "x", "d": "2.5", "b": "true"}[f[1][0]] if len(f) == 2 else draw.choice(TEXTS) for f in fields]
            rows.append("|".join(t if draw.random() < 0.9 else draw.choice(TEXTS) for t in easy) + ("|more" if draw.random() < 0.05 else ""))
        head = "|".join({"record_count": "3", "file_size": "9", "data_start_date": "01/02/2024"}.get(x[0].lower(), "n") if draw.random() < 0.9 else "?" for x in known)
        texts = [avro_schema("r", *fields), avro_schema("t", *target), avro_schema("h", *known)]
        if draw.random() < 0.1:
            texts[draw.randrange(3)] = draw.choice([None, "", "{"])
        out.append((f"file{k}", texts, [head, *rows]))
    return out


def _run(spark, files, settings, own):
    lines = spark.createDataFrame([(k, i, line) for k, _, rows in files for i, line in enumerate(rows)], "file_key string, i int, line string")
    names = "file_key string" + (", table_schema string, insert_table_schema string, header_schema string" if own else "")
    frame = spark.createDataFrame([(k, *texts) if own else (k,) for k, texts, _ in files], names)
    return validate_files(ordered_lines(lines, "file_key", "i", "line"), frame, "data_only", settings=settings, dialect=FORM, allow_extra=False)


def _seen(run):
    verdicts = {(r.file_key, r.code, str(r.missing_fields), str(r.invalid_fields), str(r.extra_fields), r.actual_record_count, r.claimed_count, r.metadata_file_size, r.metadata_start_date) for r in run.decided.collect()}
    lines = sorted((r.file_key, r.line) for r in run.success_lines().collect())
    errors = sorted(tuple(r) for r in run.record_errors().select("file_key", "record_id", "error_type", "field").collect())
    return verdicts, lines, errors


def test_many_schemas_are_each_alone(spark):
    files = _files(8, 5)
    verdicts, lines, errors = _seen(_run(spark, files, SETTINGS, own=True))
    alone = [set(), [], []]
    for key, texts, rows in files:
        one = dict(SETTINGS, **dict(zip(("table_schema", "insert_table_schema", "header_schema"), texts)))
        v, w, e = _seen(_run(spark, [(key, texts, rows)], one, own=False))
        alone[0] |= v
        alone[1] += w
        alone[2] += e
    assert verdicts == alone[0]
    assert (lines, errors) == (sorted(alone[1]), sorted(alone[2]))
    assert len({v[1] for v in verdicts}) > 2 and lines and errors


def test_cells_do_not_grow_with_schemas(spark):
    def cells(n):
        texts = [avro_schema("r", (f"a{k}", "long"), (f"b{k}", "string?")) for k in range(n)]
        files = [(f"file{k}", [t, t, t], ["1|x"]) for k, t in enumerate(texts)]
        run = _run(spark, files, SETTINGS, own=True)
        return distinct_cells(run.schema_table), run.schema_table.count()

    (few, n_few), (many, n_many) = cells(2), cells(1500)
    assert few == many and (n_few, n_many) == (2, 1500)


def test_places_of_a_line():
    read = FeedSchema("r", (FeedField("a"), FeedField("file_id"), FeedField("c")))
    write = FeedSchema("w", (FeedField("c"), FeedField("gone"), FeedField("file_id")))
    assert places(read, write, ids=False) == [2, -1, 1, 0]
    assert places(read, write, ids=True) == [2, -1, 1, -3, 0]


def test_equal_texts_are_parsed_once():
    text = avro_schema("r", ("a", "long"))
    group = parse_group((text, text, None), "data_only")
    assert group.read is group.write and group.code is None
    assert parse_group(("", "", None), "data_only").code == parse_group((None, None, None), "data_only").code
    assert parse_group(("{", "{", None), "data_only").code == parse_group(("{", text, None), "data_only").code is not None
