"""Reading, projecting and landing nested records."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from siltbed.functions.paths import endpoint_from_url
from siltbed.schemas import LANDED, LISTING, RECORD_KEYS

RECORD = "json_data"


def strip_outer_array(df: DataFrame, record: str = RECORD, *kept: Column) -> DataFrame:
    """One row per element where a record is an array, one row otherwise, with the columns ``kept``. Works on streams."""
    elements = F.try_variant_get(record, "$", "array<variant>")
    return df.select(F.explode(F.coalesce(elements, F.array(record))).alias(record), *kept)


def matching_path(df: DataFrame, pattern: str | None) -> DataFrame:
    """Rows of files whose whole path matches a regular expression.

    A filter on file metadata is applied to the file list, so other files are not opened.
    """
    return df if pattern is None else df.where(F.col("_metadata.file_path").rlike(f"^(?:{pattern})$"))


def json_options(multi_line: bool, malformed: str) -> dict:
    """Options of a JSON source that gives one variant per record.

    A malformed record stops the read. Spark's own default would turn it into a NULL record.
    """
    return {"singleVariantColumn": RECORD, "multiLine": multi_line, "mode": malformed}


def keyed_schema(keys: list[str]) -> T.StructType:
    return T.StructType([T.StructField(key, T.VariantType()) for key in keys])


def keyed_record(keys: list[str]) -> Column:
    """Columns of variants as one record. A JSON null stays one; a key the record lacks (SQL NULL) is left out."""
    entries = F.create_map(*(x for key in keys for x in (F.lit(key), F.col(key))))
    return F.to_variant_object(F.map_filter(entries, lambda _, value: value.isNotNull())).alias(RECORD)


def read_json_records(
    spark: SparkSession,
    path: str,
    pattern: str | None = None,
    multi_line: bool = False,
    malformed: str = "FAILFAST",
    keys: list[str] | None = None,
) -> DataFrame:
    """JSON records as one variant column: lines, arrays of records, or both mixed.

    An array is one value first, of at most 128 MiB. With ``keys``, the top-level keys to keep, the reader itself takes arrays apart record by
    record, so that only a record has to fit, and other keys are not read.
    """
    if keys is not None:
        raw = spark.read.schema(keyed_schema(keys)).options(multiLine=multi_line, mode=malformed).json(path)
        return matching_path(raw, pattern).select(keyed_record(keys))
    raw = spark.read.options(**json_options(multi_line, malformed)).json(path)
    return strip_outer_array(matching_path(raw, pattern))


def run_order(path: Column | str) -> Column:
    """The run a landing path belongs to, as text that sorts by run: numbers in its name sort as numbers.

    NULL for a path without a ``run=`` folder. File times say nothing of runs: copying or restoring files changes them.
    """
    run = F.regexp_extract(path, "/run=([^/]+)/", 1)
    padded = F.regexp_replace(run, "([0-9]+)", "00000000000000000000$1")
    padded = F.regexp_replace(padded, "0*([0-9]{20})", "$1")
    # it is evaluated for each record, and replacing takes longer than parsing it: a run that is a number alone, or has none, does without
    number, plain = run.rlike("\\A[0-9]{1,20}\\z"), ~run.rlike("[0-9]")
    return F.nullif(F.when(number, F.lpad(run, 20, "0")).when(plain, run).otherwise(padded), F.lit(""))


def strict_json(text: Column | str) -> Column:
    """A text as a variant, NULL unless it is one JSON value and nothing else.

    Spark's own parser stops at the end of the first value and would lose what comes after it. As the first of two elements
    of an array a text can only be one whole value.
    """
    both = F.try_parse_json(F.concat(F.lit("["), text, F.lit("\n,0]")))
    value, second, third = (F.try_variant_get(both, f"$[{i}]", "variant") for i in range(3))
    return F.when(second.isNotNull() & third.isNull(), value)


def byte_offsets():
    """A function of (file and split as a hash, bytes of a line) to the byte at which the line starts, counted from its split's first line.

    It relies on the order in which a task reads lines, hence must see all of them; only these two numbers go to Python.
    """

    @F.pandas_udf("long")
    def offsets(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import numpy as np
        import pandas as pd

        split, at = None, 0
        for splits, sizes in batches:
            splits, sizes = splits.to_numpy(), sizes.to_numpy() + 1
            out = np.empty(len(sizes), np.int64)
            starts = np.flatnonzero(np.append(True, splits[1:] != splits[:-1])) if len(splits) else []
            for a, b in zip(starts, [*starts[1:], len(splits)], strict=True):
                if splits[a] != split:
                    split, at = splits[a], 0
                ends = at + np.cumsum(sizes[a:b])
                out[a:b], at = ends - sizes[a:b], ends[-1]
            yield pd.Series(out)

    return offsets.asNondeterministic()  # else a filter could go before it


def set_aside_malformed(lines: DataFrame, landed: Column, multi_line: bool = False) -> DataFrame:
    """Records of text lines as variants, and beside them the lines that are none, each with the place it comes from. Works on streams.

    One pass over the files gives both: a row holds a record, or the columns of ``schemas.SET_ASIDE``. A record too large for one variant
    value (128 MiB) is set aside too. Blank lines are left out.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    offset = F.lit(0).cast("long") if multi_line else byte_offsets()(place, F.octet_length("value"))
    read = lines.select(
        "value",
        strict_json("value").alias("__record"),
        F.col("_metadata.file_path").alias("bad_file"),
        F.col("_metadata.file_block_start").alias("bad_start"),
        offset.alias("bad_offset"),
        landed.alias(LANDED),
    )
    whole = F.coalesce(F.try_variant_get("__record", "$", "array<variant>"), F.array("__record"))
    read = read.select(F.explode(whole).alias(RECORD), "value", "__record", "bad_file", "bad_start", "bad_offset", LANDED)
    bad = F.col("__record").isNull()
    told = [F.when(bad, F.col(c)).alias(c) for c in ("bad_file", "bad_start", "bad_offset")]
    read = read.where(F.col("__record").isNotNull() | (F.regexp_replace("value", "[ \\t\\r\\n]", "") != ""))
    return read.select(RECORD, LANDED, *told, F.when(bad, F.col("value")).alias("bad_text"))


def _literal_scanner():
    """What both passes over literal files share, as a closure: executors need no copy of this package."""
    import re

    inside = {q: re.compile(rf"[^{q}\\]*(?:\\.[^{q}\\]*)*", re.S) for q in "'\""}
    quotes = re.compile("['\"]")

    def scan(state, text):
        """(the quote that is open at the end, braces left open outside of strings) for a text that starts inside the quote ``state``, if any."""
        at, open_ = 0, 0
        while True:
            if state:
                at = inside[state].match(text, at).end()
                if text[at : at + 1] != state:  # the end, or an escape that covers the separator's first brace
                    return state, open_
                state, at = "", at + 1
            found = quotes.search(text, at)
            until = found.start() if found else len(text)
            open_ += text.count("{", at, until) - text.count("}", at, until)
            if not found:
                return "", open_
            state, at = found.group(), found.end()

    return scan


def _literal_parser(starts_in: dict | None = None, strict: bool = True):
    """The parser of pieces, as a closure. ``starts_in`` has the open quote of each split that starts in a string."""
    starts_in, scan = starts_in or {}, _literal_scanner()

    def parse(frames: Iterator, starts: dict | None = None) -> Iterator:
        import ast
        import json

        import pandas as pd

        columns = ["path", "start", "offset", "text", "part", "problem"]
        starts = starts_in if starts is None else starts

        def fault(text):
            """Why a text is no record."""
            try:
                names = sorted({n.id for n in ast.walk(ast.parse(text.strip(), mode="eval")) if isinstance(n, ast.Name)})
            except (SyntaxError, ValueError, RecursionError, MemoryError) as told:
                return f"no literal: {getattr(told, 'msg', told)}"
            return f"holds {', '.join(names)}, which is no value" if names else "is no record of JSON values"

        def row(place, pieces, braces):
            text = "},{".join(pieces).strip()
            if not text:
                return None
            # a separator took the braces around it; a first piece kept its opening brace, a last one its closing
            if not text.startswith("{"):
                text, braces = "{" + text, braces + 1
            text = text + "}" if braces == 1 else text.rstrip(", \r\n\t")
            try:
                value = ast.literal_eval(text)
                if not isinstance(value, dict):
                    raise ValueError
                return (*place, json.dumps(value, ensure_ascii=False, allow_nan=False), None, None)
            except (SyntaxError, ValueError, TypeError, RecursionError, MemoryError):
                return bad(place, text, fault(text))

        def bad(place, text, problem):
            if strict:
                raise ValueError(f"unreadable record in {place[0]}, byte {place[2]} of the split at {place[1]}: {problem}")
            return (*place, text, "bad", problem)

        where, state, at, held, braces, begun, head, ends = None, "", 0, [], 0, 0, False, True

        def left():
            """What a split ends with inside a string: the record goes on in the next split, unless the file ends here."""
            if not held:
                return []
            text = "},{".join(held)
            if ends and not head:
                return [bad((*where, begun), text, "a string has no end")]
            return [(*where, begun, text, "middle" if head else "tail", None)]

        for frame in frames:
            out = []
            lasts = frame["last"] if "last" in frame else [True] * len(frame)
            for path, start, last, piece in zip(frame["path"], frame["start"], lasts, frame["value"]):
                if (path, start) != where:
                    out += left()
                    where, at, held, braces, begun, ends = (path, start), 0, [], 0, 0, last
                    state = starts.get(where, "")
                    head = bool(state)  # the split starts with the rest of a record
                held.append(piece)
                state, more = scan(state, piece)
                braces += more
                at += len(piece.encode()) + 3
                if not state:
                    if head:
                        out.append((*where, begun, "},{".join(held), "head", None))
                    elif (made := row((*where, begun), held, braces)) is not None:
                        out.append(made)
                    held, braces, begun, head = [], 0, at - 1, False  # its brace is the separator's last byte
            yield pd.DataFrame(out, columns=columns)
        if last_rows := left():
            yield pd.DataFrame(last_rows, columns=columns)

    def join(frame):
        """The records of one file that lie in several splits, from their parts."""
        import pandas as pd

        order = {"head": 0, "middle": 1, "tail": 2}
        parts = sorted(frame.to_dict("records"), key=lambda r: (r["start"], order[r["part"]]))
        out, held = [], []
        for r in parts:
            held.append(r)
            if r["part"] == "head" or r is parts[-1]:
                # as if it had been read in one piece, under the place where it starts
                first, text = held[0], "},{".join(h["text"] for h in held)
                whole = pd.DataFrame({"path": [first["path"]], "start": [first["start"]], "value": [text]})
                out += [made.assign(offset=first["offset"]) for made in parse([whole], {})]
                held = []
        return pd.concat(out)

    parse.join = join
    return parse


def _split_states():
    """Per split the quote open at its end, for each quote it may start in."""
    scan = _literal_scanner()

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        where, states = None, None

        def row():
            return pd.DataFrame([(*where, *states)] if where else [], columns=["path", "start", "plain", "single", "double"])

        for frame in frames:
            for path, start, piece in zip(frame["path"], frame["start"], frame["value"]):
                if (path, start) != where:
                    yield row()
                    where, states = (path, start), ["", "'", '"']
                states = [scan(s, piece)[0] for s in states]
        yield row()

    return run


def _bytes(setting: str) -> int:
    """A size setting (``128MB``, ``16m``, ``4194304b``) in bytes."""
    text = setting.lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def _splits_in_strings(pieces: DataFrame) -> dict[tuple[str, int], str]:
    """The splits that start inside a string, with its quote. Only files of several splits are looked into, and such a split is rare."""
    conf = pieces.sparkSession.conf
    least = F.least(*(F.expr(f"{_bytes(conf.get(f'spark.sql.files.{c}'))}L") for c in ("maxPartitionBytes", "openCostInBytes")))
    several = pieces.where((F.col("size") > least) & (F.col("block") < F.col("size"))).select("path", "start", "value")
    told = several.mapInPandas(_split_states(), "path string, start long, plain string, single string, double string")
    by_file = told.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "plain", "single", "double"))).alias("splits"))
    walked = F.expr(
        """aggregate(splits, named_struct('now', '', 'found', cast(array() as array<struct<start: bigint, quote: string>>)),
            (a, x) -> named_struct(
                'now', case a.now when '' then x.plain when '"' then x.double else x.single end,
                'found', if(a.now = '', a.found, concat(a.found, array(named_struct('start', x.start, 'quote', a.now))))))"""
    )
    found = by_file.select("path", F.explode(walked["found"]).alias("f")).select("path", "f.*").collect()
    return {(r.path, r.start): r.quote for r in found}


def _whole_file_parser():
    def parse(frames: Iterator) -> Iterator:
        import ast
        import json

        import pandas as pd

        for frame in frames:
            for text in frame["value"]:
                records = ast.literal_eval("[" + text.strip() + "]")
                yield pd.DataFrame({"text": [json.dumps(r, ensure_ascii=False) for r in records]}, dtype="object")

    return parse


_PARSED = "path string, start long, offset long, text string, part string, problem string"


def read_literal_records(spark: SparkSession, path: str, whole_files: bool = False, malformed: str = "FAILFAST") -> DataFrame:
    """Records that were landed as comma-joined Python literals, as one variant column.

    Two records meet in ``},{``, and Spark can split a large file at that text. It may also occur in a string, so a scanner
    follows quotes and escapes from piece to piece: a record ends where a piece ends outside of strings, and each character is looked at
    once, however many records are bad. Files of several splits are scanned once before, for the quotes that are open where
    their splits meet, and a record that lies in several splits is put together from its parts.

    A text that is no record (``nan`` and ``inf`` are none) stops the read with its file and place. With ``QUARANTINE`` it is a row of its own
    instead, with the columns of ``schemas.SET_ASIDE``. ``whole_files`` reads each file in one piece.
    """
    if whole_files:
        text = spark.read.option("wholetext", True).text(path)
        parsed = text.mapInPandas(_whole_file_parser(), "text string")
        return parsed.select(F.parse_json("text").alias(RECORD))
    meta = {"path": "file_path", "start": "file_block_start", "block": "file_block_length", "size": "file_size"}
    text = spark.read.option("lineSep", "},{").text(path)
    pieces = text.select("value", *(F.col(f"_metadata.{name}").alias(c) for c, name in meta.items()))
    starts_in = _splits_in_strings(pieces)
    parser = _literal_parser(starts_in, malformed != "QUARANTINE")
    pieces = pieces.select("path", "start", (F.col("start") + F.col("block") >= F.col("size")).alias("last"), "value")
    parsed = pieces.mapInPandas(parser, _PARSED)
    if starts_in:
        # files with a record in several splits are read once more for its parts
        cut = pieces.where(F.col("path").isin(sorted({path for path, _ in starts_in}))).mapInPandas(parser, _PARSED)
        parts = cut.where("part in ('head', 'middle', 'tail')").groupBy("path").applyInPandas(parser.join, _PARSED)
        parsed = parsed.where("part is null or part = 'bad'").unionByName(parts)
    bad = F.col("part").isNotNull()
    record = F.when(~bad, F.parse_json(F.when(~bad, F.col("text")))).alias(RECORD)
    if malformed != "QUARANTINE":
        return parsed.select(record)
    told = {"path": "bad_file", "start": "bad_start", "offset": "bad_offset", "text": "bad_text"}
    return parsed.select(record, *(F.when(bad, F.col(c)).alias(name) for c, name in told.items()))


def project_keys(record: Column | str, keys: list[str] = RECORD_KEYS) -> Column:
    """A variant object reduced to some of its top-level keys; nested values keep their types."""
    entries = F.variant_get(record, "$", "map<string, variant>")
    return F.to_variant_object(F.map_filter(entries, lambda key, _: key.isin(keys)))


def resource_catalog(listing: DataFrame, payload: str = "payload") -> DataFrame:
    """The records a listing payload (JSON text) names: one (url, endpoint) row each.

    A malformed payload stops the read, as its records would be missed without a word; ``unreadable_payloads`` finds such
    payloads, and a listing without them can be read.
    """
    results = F.from_json(payload, LISTING, {"mode": "FAILFAST"})["results"]
    urls = listing.select(F.explode(results).alias("r")).select(F.col("r.url").alias("url"))
    return urls.select("url", endpoint_from_url("url").alias("endpoint"))


def unreadable_payloads(listing: DataFrame, payload: str = "payload") -> DataFrame:
    """The rows whose listing payload is not JSON of the expected shape. A NULL payload names nothing and is readable."""
    corrupt = F.from_json(payload, f"{LISTING}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    return listing.withColumn("__read", corrupt).where("__read._corrupt is not null").drop("__read")


def landing_path(root: str, endpoint: str, run: str) -> str:
    return f"{root}/run={run}/{endpoint}"


#: Records of a landed file: a gzipped one is read by one task.
FILE_RECORDS = 100_000
#: How landed files are written. What repeats in every record is found at the least effort too, which takes a third of the usual one's time.
_LANDING = {"maxRecordsPerFile": FILE_RECORDS, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def land_records(records: DataFrame, root: str, endpoint: str, run: str, replace: bool = False) -> str:
    """Write a variant column, or any columns, as JSON lines into the run's own folder; returns the folder.

    Each run has a new path: a file stream does not read a path again after it was rewritten. ``replace``
    overwrites the folder of the same run. Files are gzipped, as names and URLs repeat in every record; as one task reads such a
    file, a task that writes many records writes several.
    """
    path = landing_path(root, endpoint, run)
    mode = "overwrite" if replace else "errorifexists"
    if records.columns == [RECORD]:
        records.select(F.to_json(RECORD).alias("value")).write.mode(mode).options(**_LANDING).text(path)
    else:
        records.write.mode(mode).options(**_LANDING).json(path)
    return path
