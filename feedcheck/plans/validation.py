"""Validate whole feed files: one verdict per file, and the lines that follow from it.

The plan is one scan of the lines. Lines are numbered by chunk, cut into header, data
and footer, checked against their file's schema, and summed up per file in one
aggregate with a few numbers of state. Verdicts are then decided on a frame with one
row per file.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import codes
from ..functions.delimited import field_at, quote_field
from ..functions.dialect import DIALECT_COLUMNS, Dialect, dialect, with_dialects
from ..functions.text import compiles
from ..operators import metadata as md
from ..operators import reconcile as rc
from ..operators import schemas as sc
from ..operators import validate as va
from ..operators.audit import at_least, audit_event, audit_rows
from ..operators.config import SETTINGS, check_config, metadata_line_setting, with_all_settings
from ..operators.framing import chosen_file_id, frame, number_lines, rows_text, with_record_id
from ..session import broadcast_if_small, materialise
from ..sources.lines import LineSource, scanned_key

# A stop's rank: the record at which it happens, then parse before processing.
_STEP, _PROCESSING = 16, 8


@dataclass(frozen=True)
class Validation:
    """One run over ``src`` and ``files``.

    ``files`` has one row per file: ``file_key`` and any of the settings as text
    columns. ``settings`` gives values that hold for every file. ``profile`` is
    ``data`` (claimed count is an attribute), ``data_only`` (the file states its own
    count) or ``manifest``. Columns ``field_separator``, ``quote_char`` and ``escape_char``
    of ``files`` are each file's own dialect, in the same scan; blank and comment lines are
    a matter of the scan.

    A source of scanned files knows what was listed: a file of ``files`` that was not there
    fails, and an empty one has no records. Its keys may spell the file system in any way
    (``file:///a``, ``file:/a``, ``/a``).
    """

    src: LineSource
    files: DataFrame
    profile: str = "data_only"
    settings: dict = field(default_factory=dict)
    dialect: Dialect = field(default_factory=lambda: dialect(sep="|"))
    writer: Dialect | None = None
    allow_extra: bool = False
    strict: bool = True
    lenient_dates: bool = False

    # ---- settings ------------------------------------------------------------

    @cached_property
    def _group(self) -> sc.Group | None:
        """The one set of schemas, where it is a setting of the run; none where each file has its own."""
        if set(sc.SCHEMAS) & set(self.files.columns):
            return None
        return sc.parse_group(tuple(self.settings.get(c) for c in sc.SCHEMAS), self.profile)

    @cached_property
    def schema_table(self) -> DataFrame:
        """Schemas of the files, where each has its own: one row per set of schema texts."""
        own = [c if c in self.files.columns else F.lit(self.settings.get(c)).cast("string").alias(c) for c in sc.SCHEMAS]
        return sc.schema_table(self.files.select(*own), self.profile)

    @property
    def _checks(self) -> bool:
        """False where the run's one set of schemas is unusable, so that no record is checked."""
        return self._group is None or self._group.code is None

    def _patterns(self, part: str) -> list[str]:
        return sc.metadata_patterns(self.schema_table, part)

    @cached_property
    def checked_files(self) -> DataFrame:
        """Files with their settings, schema group, counts and configuration verdict."""
        known = {k: F.lit(v).cast("string") for k, v in self.settings.items() if k not in self.files.columns}
        # A file that is listed more than once has one row, which says so.
        own = Window.partitionBy("file_key")
        files = self._keyed_files
        order = [F.col(c).cast("string") for c in self.files.columns if c != "file_key"] or [F.lit(0)]
        files = files.withColumns({"listings": F.count(F.lit(1)).over(own), "__place": F.row_number().over(own.orderBy(*order))})
        files = files.filter("__place = 1").drop("__place")
        if self._own_dialects:
            files = with_dialects(files, self.dialect)
        landed = self.src.landed
        if landed is not None:
            files = files.join(landed.select("file_key", F.lit(True).alias("landed")), "file_key", "left")
        absent = F.col("landed").isNull() if landed is not None else F.lit(False)
        files = with_all_settings(files.withColumns(known))
        if self._group:
            files = files.withColumns({"schema_group": F.lit(0).cast("bigint"), "schema_code": F.lit(self._group.code).cast("string")})
        else:
            own = self.schema_table.withColumnsRenamed({c: "__" + c for c in sc.SCHEMAS})
            same = [F.col(c).eqNullSafe(F.col("__" + c)) for c in sc.SCHEMAS]
            files = files.join(broadcast_if_small(own), same, "left").drop(*["__" + c for c in sc.SCHEMAS])
            files = files.withColumn("schema_code", F.col("schema.code"))
        files = check_config(files, self.profile)
        if self.profile == "data_only":
            files = metadata_line_setting(files)
        else:
            files = files.withColumns({"metadata_line": F.lit(0), "metadata_setting_code": F.lit(None).cast("string")})
        doubled = F.when(F.col("listings") > 1, F.lit(codes.PROFILES[self.profile]["attribute"]))
        missing = F.when(absent, F.lit(codes.PROFILES[self.profile]["io"]))
        early = F.coalesce(doubled, missing, "schema_code", "config_code", "metadata_setting_code")
        location = F.lower("record_count_location")
        reads_text = F.lit(self.profile != "data")
        return files.withColumns(
            {
                "early_code": early,
                "wants_header": reads_text & ((location == "header") | (F.col("metadata_line") > 0)),
                "wants_footer": reads_text & location.isin("footer", "header_metadata_and_footer"),
            }
        )

    @cached_property
    def _keyed_files(self) -> DataFrame:
        """Files under the keys that a scan reports, where the source is one."""
        return self.files if self.src.landed is None else self.files.withColumn("file_key", scanned_key(self.files.sparkSession, F.col("file_key")))

    @property
    def _own_dialects(self) -> bool:
        return any(c in self.files.columns for c in DIALECT_COLUMNS if c != "comment_marker")

    @property
    def _dialect_columns(self) -> list[str]:
        return ["dialect"] if self._own_dialects else []

    @property
    def _schema_columns(self) -> list[str]:
        return [] if self._group else ["schema"]

    @property
    def _reads_sections(self) -> bool:
        """False when no file can need its header or footer text."""
        if self.profile == "data":
            return False
        fixed = self.settings.get("record_count_location")
        own = {"record_count_location", "metadata_header_record"} & set(self.files.columns)
        return bool(own) or (fixed or "").lower() not in ("none", "filename") or bool(self.settings.get("metadata_header_record"))

    # ---- lines ---------------------------------------------------------------

    def _framed(self, files: DataFrame) -> DataFrame:
        return with_record_id(frame(number_lines(self.src, files)))

    @cached_property
    def framed(self) -> DataFrame:
        """Numbered lines of every file whose settings are usable, with their section."""
        usable = self.checked_files.filter(F.col("early_code").isNull())
        return self._framed(usable.select("file_key", "schema_group", "header_n", "footer_n", "wants_header", "wants_footer", *self._dialect_columns, *self._schema_columns))

    @cached_property
    def _checker(self) -> va.Checker:
        if self._group is None:
            return va.Checker(None, self.dialect, self.strict, self.lenient_dates, sc.distinct_cells(self.schema_table))
        schema = None if self._group.code else self._group.read
        return va.Checker(schema, self.dialect, self.strict, self.lenient_dates)

    def _prepared(self, rows: DataFrame) -> DataFrame:
        return self._checker.prepare(va.with_fields(rows, self.dialect))

    def _masked(self, rows: DataFrame) -> DataFrame:
        return self._checker.with_masks(self._prepared(rows))

    def record_errors(self) -> DataFrame:
        """One row per error of each data record."""
        rows = self._masked(self.framed.filter(F.col("section") == "data"))
        errors = self._checker.errors(self.allow_extra) if self._checks else F.lit(None).cast("array<struct<type:string,field:string>>")
        return va.record_errors(rows.withColumn("errors", errors), ["file_key", "line_no", "record_id"])

    def _metadata_stop(self) -> Column:
        """Stop of a valid manifest record whose known fields cannot be taken over."""

        checker = self._checker
        if not self._checks:
            return F.lit(None).cast("int")
        if self._group:
            _, number, date = md.metadata_values(self._group.read, lambda i: F.col(f"__t{i}"), self.lenient_dates)
        else:
            texts = F.array(*[F.col(f"__t{i}") for i in range(checker.width)])
            _, number, date = md.metadata_values_of(F.col("schema.read"), lambda i: F.get(texts, i), self._patterns("read"), self.lenient_dates)
        stop = F.when(number, F.lit(va.STOPS.index("illegal_argument"))).when(date, F.lit(va.STOPS.index("date")))
        return F.when(~checker.has_error(self.allow_extra), stop)

    @cached_property
    def summary(self) -> DataFrame:
        """One row per file: lines, first hard stop, error masks, header and footer rows."""
        rows = self._masked(self.framed)
        data = F.col("section") == "data"
        at = (F.col("line_no") + F.col("footer_n")) * _STEP + _PROCESSING
        rank = F.when(F.col("fields").isNull(), F.col("line_no") * _STEP).when(data, at + F.col("stop"))
        if self.profile == "manifest":
            rank = F.coalesce(rank, F.when(data, at + self._metadata_stop()))
        columns = {"stop_rank": rank, "n_fields": F.when(data, F.size("fields"))}
        names = [f"{k}_{i}" for i in range(self._checker.n_masks) for k in ("missing", "invalid")]
        columns.update({n: F.when(data & F.col("fields").isNotNull(), F.col(n)) for n in names})
        aggs = [
            F.count(F.lit(1)).alias("n_lines"),
            F.min("stop_rank").alias("stop_rank"),
            F.max("n_fields").alias("max_fields"),
            *[F.bit_or(n).alias(n) for n in names],
        ]
        keep = ["file_key", *[v.alias(k) for k, v in columns.items()]]
        if self._reads_sections:
            row = F.struct("line_no", "fields")
            keep.append(F.when((F.col("section") == "header") & F.col("wants_header"), row).alias("header_row"))
            keep.append(F.when((F.col("section") == "footer") & F.col("wants_footer"), row).alias("footer_row"))
            aggs += [F.collect_list("header_row").alias("header_rows"), F.collect_list("footer_row").alias("footer_rows")]
        out = rows.select(*keep).groupBy("file_key").agg(*aggs)
        if not self._reads_sections:
            none = F.lit(None).cast("array<struct<line_no:bigint,fields:array<string>>>")
            out = out.withColumns({"header_rows": none, "footer_rows": none})
        return out

    # ---- verdicts ------------------------------------------------------------

    @cached_property
    def verdicts(self) -> DataFrame:
        """One row per file of ``files``, and one per file of the source that ``files`` does
        not list, which fails. The first of these decides: listed more than once, schema
        text, settings, metadata line setting, hard stop or metadata line error at the
        earliest record, record count, schema errors; else the file passes."""
        code = codes.PROFILES[self.profile]
        v = self.checked_files.join(self.summary, "file_key", "left")
        n = F.coalesce("n_lines", F.lit(0).cast("bigint"))
        v = v.withColumn("actual_count", n - F.col("header_n") - F.col("footer_n"))

        # Metadata line: mapped by position to the header schema of the file's group.
        fields_type = ", ".join(f"{f}:{'bigint' if f in md.LONG_FIELDS else 'string'}" for f in md.FIELDS)
        kind = f"struct<{fields_type}, has_count:boolean, code:string>"

        def header_of() -> Column:
            names = [F.lit(None).cast("bigint" if f in md.LONG_FIELDS else "string").alias(f) for f in md.FIELDS]

            def failed(why):
                return F.struct(*names, F.lit(False).alias("has_count"), why.alias("code"))

            if self._group is None:
                found = md.header_metadata_of(F.col("meta_fields"), F.col("schema.header"), self._patterns("header"), self.lenient_dates)
                return F.when(F.col("schema.header").isNull(), failed(F.col("schema.header_code"))).otherwise(found)
            if self._group.header is None:
                return failed(F.lit(self._group.header_code))
            return md.header_metadata(F.col("meta_fields"), self._group.header, self.lenient_dates)

        hit = F.filter(F.col("header_rows"), lambda r: (r["line_no"] == F.col("metadata_line")) & r["fields"].isNotNull())
        trimmed = F.transform(F.get(hit, F.lit(0))["fields"], lambda x: F.trim(x) if self.dialect.trim else x)
        v = v.withColumn("meta_fields", trimmed)
        found = header_of() if self.profile == "data_only" and self._reads_sections else F.lit(None).cast(kind)
        v = v.withColumn("metadata", F.when(F.col("meta_fields").isNotNull() & F.col("early_code").isNull(), found))

        # Hard stops.
        stop_code = F.lit(None).cast("string")
        for i, name in enumerate(va.STOPS):
            rank_i = (F.col("stop_rank") % _STEP) == (0 if i == 0 else _PROCESSING + i)
            stop_code = F.when(rank_i, F.lit(code[name])).otherwise(stop_code)
        meta_rank = F.when(F.col("metadata.code").isNotNull(), F.col("metadata_line") * _STEP + _PROCESSING)
        meta_first = meta_rank.isNotNull() & (F.col("stop_rank").isNull() | (meta_rank < F.col("stop_rank")))
        v = v.withColumn("hard_code", F.when(meta_first, F.col("metadata.code")).otherwise(stop_code))

        v = self._with_claim(v, code)
        no_names = F.array().cast("array<string>")
        n_masks = self._checker.n_masks
        v = v.withColumn("__names", F.coalesce(self._checker.names, no_names) if self._checks else no_names)
        v = v.withColumns(
            {
                "missing_fields": va.mask_names(F.col("__names"), "missing", n_masks),
                "invalid_fields": va.mask_names(F.col("__names"), "invalid", n_masks),
                "extra_fields": no_names if self.allow_extra else va.extra_names(F.size("__names"), F.col("max_fields")),
            }
        )
        wrong = (F.size("missing_fields") + F.size("invalid_fields") + F.size("extra_fields")) > 0
        schema_error = F.when(wrong, F.lit(code["schema_errors"]))
        v = v.withColumn("code", F.coalesce("early_code", "hard_code", "count_code", schema_error, F.lit(code["success"])))
        ok = F.col("code") == code["success"]
        count_shown = F.coalesce(F.col("claimed_count").cast("string"), F.lit("none"))
        counts = F.concat(
            F.lit("Received Record Count : "), count_shown, F.lit(" Actual Record Count : "), F.col("actual_count").cast("string")
        )
        stop_line = F.when(F.col("stop_rank") % _STEP == 0, F.floor(F.col("stop_rank") / _STEP)).otherwise(
            F.floor(F.col("stop_rank") / _STEP) - F.col("footer_n")
        )
        message = (
            F.when(ok, F.lit("File is validated successfully"))
            .when(F.col("listings") > 1, F.concat(F.lit("file is listed "), F.col("listings").cast("string"), F.lit(" times")))
            .when((F.col("code") == code["io"]), F.lit("file was not there to be read"))
            .when(F.col("code") == code["attribute"], F.array_join(F.transform("config_errors", lambda e: e["msg"]), "; "))
            .when(F.col("code") == code["malformed"], F.concat(F.lit("malformed record "), stop_line.cast("string")))
            .when(F.col("code") == code["date"], F.concat(F.lit("date does not match its pattern at record "), stop_line.cast("string")))
            .when(F.col("code") == code["count_mismatch"], F.concat(F.lit("record counts did not match. "), counts))
            .when(
                F.col("code") == code["schema_errors"],
                va.error_message(F.col("missing_fields"), F.col("extra_fields"), F.col("invalid_fields")),
            )
            .otherwise(F.concat(F.lit("failed with code "), F.col("code")))
        )
        out = {
            "status": F.when(ok, F.lit("success")).otherwise(F.lit("failure")),
            "message": message,
            "actual_record_count": F.when(F.col("early_code").isNull(), F.col("actual_count")),
        }
        shown = [
            "file_key", "file_name", "file_uuid", "file_id", "conf_id", "status", "code", "message", "actual_record_count",
            "claimed_count", "count_status", "missing_fields", "extra_fields", "invalid_fields", "config_errors",
            "schema_group", "header_n", "footer_n", "add_file_and_record_id", "file_uuid_or_id", "datafile_extension",
        ]
        v = v.withColumns(out)
        attrs = []
        if self.profile == "data_only":
            attrs = [F.when(ok, c).alias(k) for k, c in md.attributes(F.col("metadata"), "metadata").items()]
        if self.profile == "manifest":
            attrs = [F.when(ok, F.coalesce("claimed_text", F.lit(""))).alias("metadata_record_count")]
        if "actual_file_size" in self.files.columns:
            attrs.append(F.when(ok, F.col("actual_file_size").cast("string")).alias("actual_file_size"))
        carried = [c for c in self.files.columns if c not in (*shown, *SETTINGS, "actual_file_size")] + self._dialect_columns
        listed = v.select(*shown, *attrs, *carried)
        seen = self.src.chunks.select("file_key") if self.src.landed is None else self.src.landed.select("file_key")
        unlisted = seen.join(self._keyed_files, "file_key", "left_anti").distinct()
        unlisted = unlisted.withColumns(
            {"status": F.lit("failure"), "code": F.lit(code["attribute"]), "message": F.lit("file is not listed")}
        )
        return listed.unionByName(unlisted, allowMissingColumns=True)

    def _with_claim(self, v: DataFrame, code: dict) -> DataFrame:
        """Add ``claimed_text, claimed_count, count_status, count_code``."""
        null = F.lit(None).cast("string")
        actual = F.col("actual_count")
        if self.profile == "data":
            claimed = F.col("metadata_record_count").try_cast("bigint")
            status = rc.compare(claimed, actual)
            return v.withColumns(
                {
                    "claimed_text": F.col("metadata_record_count"),
                    "claimed_count": claimed,
                    "count_status": F.when(F.col("early_code").isNull(), status),
                    "count_code": F.when(status != "matched", F.lit(code["count_mismatch"])),
                }
            )
        location = F.lower("record_count_location")
        from_text = location.isin("header", "footer", "filename", "header_metadata_and_footer")
        sep = F.coalesce("field_separator", F.lit("null"))
        text = (
            F.when(location == "header", rows_text(F.col("header_rows"), sep))
            .when(location.isin("footer", "header_metadata_and_footer"), rows_text(F.col("footer_rows"), sep))
            .when(location == "filename", F.col("file_name"))
        )
        v = v.withColumn("__bad_filter", ~compiles(F.col("record_count_filter")))
        bad = F.coalesce("__bad_filter", F.lit(False))
        pattern = F.when(bad, F.lit("")).otherwise(F.col("record_count_filter"))
        v = v.withColumns({"__text": text, "__pattern": pattern})
        state, count = rc.claim_status(F.col("__text"), F.col("__pattern"))
        _, match = rc.claimed_text(F.col("__text"), F.col("__pattern"))
        v = v.withColumns({"__state": F.when(from_text, state), "__count": F.when(from_text, count)})
        failed = (
            F.when(from_text & bad, F.lit(code["illegal_argument"]))
            .when(F.col("__state") == "no_text", F.lit(code["null_pointer"]))
            .when(F.col("__state") == "not_found", F.lit(code["filter_failed"]))
            .when(F.col("__state") == "unparsed", F.lit(code["count_text"]))
        )
        claimed = F.col("__count")
        if self.profile == "data_only":
            in_meta = location.isin("header_metadata", "header_metadata_and_footer")
            meta_count = F.col("metadata.record_count")
            needs_count = (location == "header_metadata") | F.col("metadata.has_count")
            failed = (
                F.when(failed.isNotNull(), failed)
                .when(in_meta & F.col("metadata").isNull(), F.lit(code["metadata_not_found"]))
                .when(in_meta & needs_count & meta_count.isNull(), F.lit(code["metadata_no_count"]))
                .when(in_meta & needs_count & (location != "header_metadata") & (meta_count != claimed), F.lit(code["metadata_footer_differ"]))
            )
            claimed = F.when(location == "header_metadata", meta_count).otherwise(claimed)
        status = (
            F.when(location == "none", F.lit("skipped"))
            .when(failed.isin(code["filter_failed"], *([code["metadata_not_found"]] if self.profile == "data_only" else [])), F.lit("not_found"))
            .when(failed.isNotNull(), F.lit("unparsed"))
            .otherwise(rc.compare(claimed, actual))
        )
        return v.withColumns(
            {
                "claimed_text": F.when(from_text, match),
                "claimed_count": claimed,
                "count_status": F.when(F.col("early_code").isNull(), status),
                "count_code": F.when(failed.isNotNull(), failed).when(status == "mismatched", F.lit(code["count_mismatch"])),
            }
        )

    # ---- routing -------------------------------------------------------------

    @cached_property
    def decided(self) -> DataFrame:
        """Verdicts as a written table, so that routing does not validate again."""
        return materialise(self.verdicts, "verdicts")

    def original_lines(self, status: str) -> DataFrame:
        """Lines of the files with this status as they were received, blank lines and
        comments too. One bad record fails a whole file; a passing manifest goes on with
        header and footer."""
        files = self.decided.filter(F.col("status") == status).select("file_key")
        return number_lines(self.src.received(), files).select("file_key", "line_no", "line")

    def _with_own_schemas(self, files: DataFrame) -> DataFrame:
        return files if self._group else files.join(self.checked_files.select("file_key", "schema"), "file_key")

    def _passing(self) -> DataFrame:
        files = self.decided.filter(F.col("status") == "success")
        chosen = chosen_file_id(F.col("file_uuid_or_id"), F.col("file_uuid"), F.col("file_id"))
        files = files.select(
            "file_key", "schema_group", "header_n", "footer_n",
            F.when(F.col("add_file_and_record_id") == "1", F.lit(True)).otherwise(F.lit(False)).alias("adds_ids"),
            chosen.alias("chosen_id"), *self._dialect_columns,
        )
        return self._prepared(self._framed(self._with_own_schemas(files)).filter(F.col("section") == "data"))

    def success_records(self, schema: str | None = None) -> DataFrame:
        """Typed data records of passing files. Where files have schemas of their own, those of the files whose
        ``table_schema`` is the text ``schema``."""
        if self._group:
            read, rows = self._group.read, self._passing()
        else:
            read = sc.schema_from_avro_json(schema)
            groups = self.schema_table.filter(F.col("table_schema") == schema).select("schema_group").distinct()
            rows = self._passing().join(broadcast_if_small(groups), "schema_group", "left_semi")
        typed = [self._checker.value(i, f).alias(f.name) for i, f in enumerate(read.fields)]
        return rows.select("file_key", "line_no", "record_id", *typed)

    def success_lines(self) -> DataFrame:
        """Data records of passing files as they are written: write-schema fields by name,
        an absent one empty, then every field the write schema does not name."""
        w = self.writer or self.dialect
        rows = self._passing()
        checker, group = self._checker, self._group
        # Each value is rendered once, whatever number of schemas place it in a line.
        shown: dict[str, Column] = {
            "__id": quote_field(F.col("chosen_id"), w),
            "__record_id": quote_field(F.col("record_id").cast("string"), w, numeric=True),
            "__null": quote_field(F.lit(None).cast("string"), w),
        }
        texts: dict[str, Column] = {}
        at: dict[int, list[str]] = {}
        for i, f in checker.cells:
            name = va.cell_name(i, f)
            texts[f"{name}_text"] = checker.value(i, f).cast("string")
            shown[name] = quote_field(F.col(f"{name}_text"), w, numeric=f.type != "string")
            at.setdefault(i, []).append(name)
        rows = rows.withColumns(texts).withColumns(shown)
        fixed = {sc.NULL_PLACE: "__null", sc.FILE_ID_PLACE: "__id", sc.RECORD_ID_PLACE: "__record_id"}

        def line(ids: bool) -> Column:
            if group is None:
                return sc.line_by_places(F.col("__values"), F.col("schema.id_places" if ids else "schema.places"), F.col("__id"), F.col("__record_id"), F.col("__null"), w.sep)
            names = [fixed[p] if p < 0 else at[p][0] for p in sc.places(group.read, group.write, ids)]
            return F.concat_ws(w.sep, *[F.col(n) for n in names])

        if group is None:
            # The value at a position, by the kind that the row's schema has there.
            cells = {i: F.get("schema.cells", F.lit(i)) for i in at}
            kinds = [F.coalesce(*[F.when(cells[i] == n, F.col(n)) for n in dict.fromkeys(at[i])]) for i in sorted(at)]
            rows = rows.withColumn("__values", F.array(*kinds).cast("array<string>"))
        elif group.code:
            return rows.select("file_key", "record_id", F.lit(None).cast("string").alias("line"))
        text = F.when(F.col("adds_ids"), line(True)).otherwise(line(False))
        if self.allow_extra:
            n_names = F.size(checker.names)
            more = F.filter("fields", lambda _, i: i >= n_names)
            tail = F.transform(more, lambda x: F.concat(F.lit(w.sep), quote_field(F.trim(x) if self.dialect.trim else x, w)))
            text = F.concat(text, F.array_join(tail, ""))
        text = F.concat(text, F.lit(w.sep)) if w.trailing_delimiter else text
        return rows.select("file_key", "record_id", text.alias("line"))

    def manifest_rows(self) -> DataFrame:
        """One row per record of each passing manifest, with the manifest's attributes."""
        attrs = self.decided.filter(F.col("status") == "success")
        carried = ["file_key", "file_name", "file_uuid", "conf_id", "datafile_extension"]
        files = attrs.select(*carried, "schema_group", "header_n", "footer_n", *self._dialect_columns)
        rows = self._framed(self._with_own_schemas(files)).filter(F.col("section") == "data")
        rows = va.with_fields(rows, self.dialect)
        if self._group:
            values, _, _ = md.metadata_values(self._group.read, lambda i: field_at(F.col("fields"), i, self.dialect), self.lenient_dates)
        else:
            texts = F.array(*[field_at(F.col("fields"), i, self.dialect) for i in range(self._checker.width)])
            values, _, _ = md.metadata_values_of(F.col("schema.read"), lambda i: F.get(texts, i), self._patterns("read"), self.lenient_dates)
        rows = rows.withColumn("metadata", F.struct(*[c.alias(n) for n, c in values.items()]))
        return md.manifest_rows(rows, ["file_key", "record_id", *carried[1:]])

    def audit(self, min_level: str = "DEBUG", records: bool = False) -> DataFrame:
        """Audit rows of this run; with ``records`` also those of single records."""
        files = audit_rows(self.decided, self.profile, min_level)
        return files.unionByName(at_least(self.record_audit(), min_level)) if records else files

    def record_audit(self) -> DataFrame:
        """Audit rows of single records: one for each that does not fit its schema, with all of its errors, and for
        manifests one at debug level for each field of a valid record whose name is none of the known ones.

        Malformed records have no fields and no row here; neither have files that were not read.
        """
        code = codes.PROFILES[self.profile]
        read = F.lit(bool(self._checks))
        errors = self._checker.errors(self.allow_extra) if self._checks else F.lit(None).cast("array<struct<type:string,field:string>>")
        rows = self._masked(self.framed.filter((F.col("section") == "data") & read)).withColumn("errors", errors)
        names = self.decided.select("file_key", "conf_id", "file_uuid", "file_name")
        why = F.array_join(F.transform("errors", lambda e: F.concat_ws(" ", e["type"], e["field"])), "; ")
        text = F.concat(F.lit("record "), F.col("record_id").cast("string"), F.lit(" is invalid: "), why)
        invalid = F.col("fields").isNotNull() & (F.coalesce(F.size("errors"), F.lit(0)) > 0)
        bad = F.when(invalid, F.struct(F.lit(code["record"]).alias("code"), text.alias("msg")))
        events = F.array_compact(F.array(bad))
        if self.profile == "manifest" and self._checks:
            values = F.array(*[F.col(f"__t{i}") for i in range(self._checker.width)])
            fields = F.filter(F.transform(self._checker.names, lambda n, i: F.struct(n.alias("name"), F.get(values, i).alias("value"))), lambda f: ~F.lower(f["name"]).isin(*md.FIELDS))
            message = "record %s: field %s is not known, its value is %s"
            unknown = F.transform(fields, lambda f: F.struct(F.lit(code["unknown_field"]).alias("code"), F.format_string(message, F.col("record_id"), f["name"], f["value"]).alias("msg")))
            events = F.when(F.col("fields").isNotNull() & ~invalid, unknown).otherwise(events)
        each = rows.select("file_key", F.explode(events).alias("event")).join(broadcast_if_small(names), "file_key")
        return audit_event(each, F.col("event.code"), F.col("event.msg"))


def validate_files(src: LineSource, files: DataFrame, profile: str = "data_only", **options) -> Validation:
    return Validation(src, files, profile, **options)
