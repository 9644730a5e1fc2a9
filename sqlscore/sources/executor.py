"""Run many candidate SQL queries against registered views, as Spark jobs.

Model-written queries differ mostly in literals. Each distinct query is turned
into a *template* (literals replaced by typed slots) inside Spark; queries
sharing a template run as **one** query: a parameter table of the members joined
``LATERAL`` to the template, which Catalyst decorrelates into an ordinary join.
Slots whose value is the same for every member are put back as literals. Up to
``UNION`` templates are written by one job. Whole results are kept: no row cap and
no time limit, so an outcome depends neither on the data's size nor on the load.

Only distinct templates reach the driver (streamed); query texts and result rows
stay in Spark, in tables under ``spark.checkpoint.dir``. A job that fails is split:
first by template, then the members of a template in halves by their hash, until the
members that fail stand alone; everything else keeps its rows.

A template with LIMIT or OFFSET, or one that does not analyse in lateral form, runs
with its members' own texts, ``UNION`` of them in one job.

Safety: the text is parsed alone first (a single query statement) and the parsed plan is
checked scope by scope: no JVM reflection, no name made at run time (IDENTIFIER), no table but
those that the row's schema declares. It is analysed and run in a session of its own in which
only these tables exist, with the declared columns only, without reading files by path and
without variable substitution.

Results may be kept across batches (:mod:`sqlscore.sources.store`): then only new queries and those
that failed before are run.
"""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Callable, Iterator

from py4j.java_gateway import is_instance_of
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import row_cells
from ..functions.text import WS_CHARS
from ..params import SQL_ERROR_PREFIX
from ..session import ensure_checkpoint_dir
from .store import ROWS_SCHEMA, ExecutionStore

# protected tokens (group 1) and literal slots (group 2); Spark lexer rules:
# strings take '' and backslash escapes, numbers must not touch a name. The
# quantifiers are possessive: literals of any length match without recursion.
TOKEN_RE_S = (r"(?s)(--[^\n]*+|/\*.*?\*/|\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\"|`[^`]*+`)"
              r"|('[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'|(?<![\w.$])\d++(?:\.\d++)?(?:[eE][+-]?\d++)?(?![\w.$]))")
STRUCTURAL_BEFORE = (r"(?i)\b(limit|offset|interval|tablesample|date|timestamp|timestamp_ntz|timestamp_ltz|x)"
                     r"[\t\n\x0B\f\r ]*\(?[\t\n\x0B\f\r ]*$")
FORBIDDEN = frozenset({"reflect", "java_method", "try_reflect"})
ERROR_SCHEMA = "query_id string, error string, error_class string"
MARK = "\u0001"   # slot marker in template text (cannot occur in SQL text)
UNION = 32        # queries written by one job
SALTS = 64        # files of a template's members


def clean_query(sql: Column) -> Column:
    """Strip blanks and one trailing ';' (a single statement may end with it)."""
    s = F.btrim(sql, F.lit(WS_CHARS))
    return F.btrim(F.regexp_replace(s, ";[" + "\\t\\n\\x0B\\f\\r " + "]*\\z", ""), F.lit(WS_CHARS))


def templatize(df: DataFrame, sql_col: str = "query") -> DataFrame:
    """Add ``template`` (text with ``\\x01k\\x01`` slot markers), ``slot_raw`` (literal
    texts), ``slot_val`` (parsed values as strings) and ``slot_kind``.

    Built from regexp_extract_all / split / transform — no Python per row.
    """
    s = F.col(sql_col)
    d = df.withColumns({"_toks": F.regexp_extract_all(s, F.lit(TOKEN_RE_S), 0), "_gaps": F.split(s, TOKEN_RE_S, -1)})
    # group 2 of the pattern: a string or a number is told from a protected token by its first character
    d = d.withColumn("_lits", F.transform("_toks", lambda x: F.when(x.rlike("^['0-9]"), x).otherwise(F.lit(""))))
    # stays inline: a literal with a backslash escape (its value needs the
    # lexer) and a structural literal that Spark needs as a constant (LIMIT n,
    # INTERVAL '1' DAY, DATE '…', X'…') — those become part of the template key
    structural = lambda i: F.coalesce(F.get(F.col("_gaps"), i).rlike(STRUCTURAL_BEFORE), F.lit(False))
    is_slot = lambda x, i: (x != "") & ~x.contains("\\") & ~structural(i)
    d = d.withColumn("_slot", F.transform("_lits", is_slot))  # once a literal: what follows looks at it several times
    d = d.withColumn("_slot_no", F.transform(
        "_slot", lambda own, i: F.when(own, F.size(F.filter(F.slice(F.col("_slot"), 1, i), lambda y: y)))))
    piece = lambda g, i: F.concat(g, F.when(
        i < F.size(F.col("_toks")),
        F.when(F.get(F.col("_slot_no"), i).isNotNull(),
               F.concat(F.lit(MARK), F.get(F.col("_slot_no"), i).cast("string"), F.lit(MARK)))
        .otherwise(F.get(F.col("_toks"), i))).otherwise(F.lit("")))
    d = d.withColumn("_tpl", F.array_join(F.transform(F.col("_gaps"), piece), ""))
    d = d.withColumn("slot_raw", F.filter("_lits", lambda x, i: F.get(F.col("_slot"), i)))
    kind = lambda x: (
        F.when(x.startswith("'"), F.lit("s"))
        .when(x.rlike("[eE]"), F.lit("e"))
        .when(x.contains("."), F.concat(F.lit("d"), (F.length(F.ltrim(F.split_part(x, F.lit("."), F.lit(1)), F.lit("0")))
                                                     + F.length(F.split_part(x, F.lit("."), F.lit(2)))).cast("string"),
                                        F.lit("_"), F.length(F.split_part(x, F.lit("."), F.lit(2))).cast("string")))
        .when(x.try_cast("int").isNotNull(), F.lit("i"))
        .when(x.try_cast("bigint").isNotNull(), F.lit("l"))
        .otherwise(F.concat(F.lit("d"), F.length(F.ltrim(x, F.lit("0"))).cast("string"), F.lit("_0"))))
    value = lambda x: F.when(
        x.startswith("'"), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit("''"), F.lit("'"))).otherwise(x)
    d = d.withColumns({"slot_kind": F.transform("slot_raw", kind), "slot_val": F.transform("slot_raw", value)})
    # the kinds are part of the template key: one column type per slot
    d = d.withColumn("template", F.concat(F.col("_tpl"), F.lit("\n--kinds:"), F.array_join(F.col("slot_kind"), ",")))
    return d.drop("_toks", "_lits", "_gaps", "_slot", "_slot_no", "_tpl")


_SPARK_TYPE = {"s": "string", "e": "double", "i": "int", "l": "bigint"}


def _slot_type(kind: str) -> str | None:
    if kind in _SPARK_TYPE:
        return _SPARK_TYPE[kind]
    m = re.fullmatch(r"d(\d+)_(\d+)", kind)
    if m:
        p, s = int(m.group(1)), int(m.group(2))
        p = max(p, s, 1)
        return f"decimal({p},{s})" if p <= 38 else None
    return None


def _error_class(exc: Exception) -> str:
    get = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    try:
        c = get() if get else None
    except Exception:  # noqa: BLE001
        c = None
    return c or type(exc).__name__


# ---- checks on the parsed plan ------------------------------------------------------

class Refused(Exception):
    """A query that parses but may not run."""

    def __init__(self, error_class: str, text: str):
        super().__init__(text)
        self.error_class = error_class


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def _plan_nodes(gateway, plan) -> Iterator[tuple]:
    """(node, names in scope) of a parsed plan: operators, expressions, subqueries and common table expressions."""
    stack = [(plan, frozenset())]
    while stack:
        node, scope = stack.pop()
        yield node, scope
        name = node.getClass().getSimpleName()
        if name == "UnresolvedWith":  # a definition sees the ones before it, the body sees all
            for r in _seq(node.cteRelations()):
                own = frozenset([r._1().lower()])
                stack.append((r._2(), scope | own if node.allowRecursion() else scope))
                scope |= own
        stack += [(c, scope) for c in _seq(node.children())]
        if is_instance_of(gateway, node, "org.apache.spark.sql.catalyst.plans.QueryPlan"):
            stack += [(c, scope) for c in _seq(node.expressions())]
        if name in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "FunctionTableSubqueryArgumentExpression"):
            stack.append((node.plan(), scope))


def check_query(session: SparkSession, text: str, tables: set[str]) -> bool:
    """Parse ``text`` alone and check it; True if it cuts its result (LIMIT, OFFSET).

    ``tables``: lower-case names of the tables it may read. Raises the parser's error, or :class:`Refused`.
    """
    if not text:
        raise Refused("PARSE_EMPTY_STATEMENT", "empty query")
    plan = session._jsparkSession.sessionState().sqlParser().parseQuery(text)
    cuts = False
    for node, scope in _plan_nodes(session.sparkContext._gateway, plan):
        kind = node.getClass().getSimpleName()
        if "UnresolvedIdentifier" in kind:
            raise Refused("IDENTIFIER_NOT_ALLOWED", "names made by IDENTIFIER are not allowed")
        if kind == "UnresolvedFunction" and _seq(node.nameParts())[-1].lower() in FORBIDDEN:
            raise Refused("FUNCTION_NOT_ALLOWED", f"function {_seq(node.nameParts())[-1]} is not allowed")
        if kind == "UnresolvedRelation":
            parts = [p.lower() for p in _seq(node.multipartIdentifier())]
            if len(parts) != 1 or (parts[0] not in scope and parts[0] not in tables):
                raise Refused("TABLE_OR_VIEW_NOT_FOUND", f"no such table: {'.'.join(parts)}")
        cuts = cuts or kind in ("GlobalLimit", "LocalLimit", "Limit", "Offset", "Tail")
    return cuts


class _Views:
    """The views of a session; only those that are declared exist while a query is analysed."""

    def __init__(self, session: SparkSession):
        self.session = session
        self.all = {t.name.lower(): session.table(t.name) for t in session.catalog.listTables() if t.isTemporary}
        self.shown: str | None = None  # None: all of them

    def show(self, declared: str | None) -> set[str]:
        """Make the declared views (``name`` or ``name(column,column)``, joined by ``;``; None: all) the only ones; their names."""
        wanted = {k: None for k in self.all}
        if declared is not None:
            entries = [re.fullmatch(r"([^(]*)(?:\((.*)\))?", x).groups() for x in declared.split(";") if x]
            wanted = {name.lower(): None if columns is None else {c.lower() for c in columns.split(",")}
                      for name, columns in entries if name.lower() in self.all}
        if declared != self.shown:
            for name in self.all:
                self.session.catalog.dropTempView(name)
            for name, columns in wanted.items():
                df = self.all[name]
                if columns is not None:
                    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() in columns])
                df.createOrReplaceTempView(name)
            self.shown = declared
        return set(wanted)


def _describe(exc: Exception) -> tuple[str, str]:
    """(whole error text, error class)."""
    own = getattr(exc, "error_class", None)
    return SQL_ERROR_PREFIX + (str(exc).strip() or type(exc).__name__), own or _error_class(exc)


# ---- the run ---------------------------------------------------------------------------

def _wrap(body: str) -> str:
    return f"SELECT * FROM (\n{body}\n) __t"


def _cells(df: DataFrame, query_id: str | None) -> DataFrame:
    """``query_id, cells`` of a result; columns by position (the first is the id if none is given)."""
    own = 0 if query_id is not None else 1
    pos = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    values = [f"_c{i}" for i in range(own, len(df.columns))]
    return pos.select((F.lit(query_id) if query_id is not None else F.col("_c0")).alias("query_id"), row_cells(pos.select(*values)).alias("cells"))


class _Run:
    """One batch: the session, the folder, and what was written and what failed."""

    def __init__(self, session: SparkSession, folder: str):
        self.session, self.folder, self.views = session, folder, _Views(session)
        self.paths: list[str] = []
        self.errors: list[tuple[str, str, str]] = []
        self.error_paths: list[str] = []
        self.seconds: list[tuple[int, float]] = []

    def write(self, rows: DataFrame) -> None:
        path = os.path.join(self.folder, "rows", f"{len(self.paths)}-{uuid.uuid4().hex[:8]}")
        rows.write.parquet(path)
        self.paths.append(path)

    def fail(self, query_id: str, exc: Exception) -> None:
        self.errors.append((query_id, *_describe(exc)))
        if len(self.errors) >= 1000:
            self.flush()

    def flush(self) -> None:
        if self.errors:
            path = os.path.join(self.folder, "errors", uuid.uuid4().hex)
            self.session.createDataFrame(self.errors, ERROR_SCHEMA).write.parquet(path)
            self.error_paths.append(path)
            self.errors = []

    # a job is a list of parts; a part builds rows for the members of one hash class
    def write_parts(self, parts: list["_Part"]) -> None:
        """Write the parts with one job; if it fails, halve it."""
        if not parts:
            return
        try:
            rows = [p.rows() for p in parts]
            union = rows[0]
            for r in rows[1:]:
                union = union.unionByName(r)
            t0 = time.perf_counter()
            self.write(union)
            spent = (time.perf_counter() - t0) / sum(p.n for p in parts)
            self.seconds += [(p.group, spent) for p in parts]
        except Exception as e:  # noqa: BLE001 - any failure of a query is an outcome
            if len(parts) > 1:
                half = len(parts) // 2
                self.write_parts(parts[:half])
                self.write_parts(parts[half:])
            else:
                for smaller in parts[0].split(self, e):
                    self.write_parts([smaller])


class _Part:
    """Some members of one template: those whose hash is ``rest`` modulo ``modulus``; or one text."""

    def __init__(self, run: _Run, group: int, members: DataFrame | None, text: str, slots: list, n: int,
                 query_id: str | None = None, modulus: int = 1, rest: int = 0, tables: str | None = None):
        self.run, self.group, self.members, self.text, self.slots, self.n = run, group, members, text, slots, n
        self.query_id, self.modulus, self.rest, self.tables = query_id, modulus, rest, tables

    def mine(self) -> DataFrame:
        return self.members.where(F.pmod(F.xxhash64("query_id"), F.lit(self.modulus)) == self.rest) if self.modulus > 1 else self.members

    def rows(self) -> DataFrame:
        session = self.run.session
        self.run.views.show(self.tables)
        if self.query_id is not None:
            return _cells(session.sql(_wrap(self.text)), self.query_id)
        view = "__params_" + uuid.uuid4().hex[:12]
        columns = [F.get(F.col("slot_val"), k).cast(kind).alias(f"__p{k}") for k, kind in self.slots]
        self.mine().select(F.col("query_id").alias("__qid"), *columns).createOrReplaceTempView(view)
        try:
            return _cells(session.sql(f"SELECT __params.__qid, __q.* FROM {view} AS __params, LATERAL ({_wrap(self.text)}) __q"), None)
        finally:
            session.catalog.dropTempView(view)

    def split(self, run: _Run, exc: Exception) -> list["_Part"]:
        if self.query_id is not None:
            run.fail(self.query_id, exc)
            return []
        if self.n <= 1:
            for r in self.mine().select("query_id", "query").toLocalIterator():  # one member
                run.fail(r["query_id"], exc)
            return []
        out = []
        for rest in (self.rest, self.rest + self.modulus):
            part = _Part(run, self.group, self.members, self.text, self.slots, 0, None, 2 * self.modulus, rest, self.tables)
            part.n = part.mine().count()
            if part.n:
                out.append(part)
        return out


def run_query_batch(spark: SparkSession, queries: DataFrame, views: Callable[[SparkSession], None], query_id: str = "query_id",
                    sql: str = "query", tables: str | None = None, out_dir: str | None = None,
                    store: ExecutionStore | None = None, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Execute every distinct query; return ``(executions, rows)``.

    ``executions``: query_id, success, error, error_class, row_count, seconds (its share of the
    job that ran it). ``rows``: query_id, cells, whole results. ``views`` registers the views on the
    session it is given; ``tables`` names an array column with the tables a query may read, as ``name`` or
    ``name(column,column)`` (NULL: all), or ``schema`` a column with the text that declares them, which is read once a
    distinct query. With a ``store``, queries whose execution it keeps are not run:
    their executions and rows come from it, ``kept`` tells which, and the successes of this batch are added.
    """
    run_name = uuid.uuid4().hex
    base = out_dir or (f"{store.path}/runs/{run_name}" if store else os.path.join(ensure_checkpoint_dir(spark), "executions", run_name))
    session = spark.newSession()
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    session.conf.set("spark.sql.variable.substitute", "false")
    views(session)
    run = _Run(session, base)
    named = tables or schema
    q = queries.select(F.col(query_id).cast("string").alias("query_id"), F.col(sql).alias("query"),
                       (F.col(named) if named else F.lit(None).cast("string")).alias("tables"))
    known = None
    if store is None:
        q = q.dropDuplicates(["query_id"])
    else:
        dealt = store.dealt(q)
        known = store.known(dealt).checkpoint()  # as it is now: this batch adds to the store below
        q = store.fresh(dealt)
    listed = declared_tables(F.col("tables")) if schema and not tables else F.col("tables")
    q = q.select("query_id", clean_query(F.col("query")).alias("query"),
                 (F.array_join(F.array_sort(listed), ";") if named else F.col("tables")).alias("tables"))
    t = templatize(q, "query").withColumn("grp", F.xxhash64("template", F.coalesce("tables", F.lit("*"))))
    path = os.path.join(base, "templates")
    # sorted by group inside salted files: the member filters below skip row groups by min and max,
    # and a shape that most queries share is spread over SALTS tasks
    salt = F.pmod(F.xxhash64("query_id"), F.lit(SALTS))
    t.repartition("grp", salt).sortWithinPartitions("grp").write.parquet(path)
    t = session.read.parquet(path)
    stats = (t.select("grp", F.posexplode("slot_val").alias("k", "v"), "slot_raw")
             .groupBy("grp", "k").agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.min(F.get(F.col("slot_raw"), F.col("k"))).alias("raw"))
             .groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("k", (F.col("_lo") != F.col("_hi")).alias("varies"), "raw"))).alias("slots")))
    groups = t.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("template").alias("template"), F.min("tables").alias("tables"),
                                  F.min_by("query", "query_id").alias("probe"), F.min("query_id").alias("probe_id"))
    refused: list[tuple[int, str, str]] = []
    ready: list[_Part] = []

    def add(part: _Part) -> None:
        nonlocal ready
        ready.append(part)
        if len(ready) >= UNION:
            run.write_parts(ready)
            ready = []

    for g in groups.join(stats, "grp", "left").toLocalIterator():  # one row a shape, streamed
        try:
            cuts = check_query(session, g["probe"], run.views.show(g["tables"]))
        except Exception as e:  # noqa: BLE001 - members share the structure, hence the outcome
            refused.append((g["grp"], *_describe(e)))
            continue
        if g["n"] == 1:
            add(_Part(run, g["grp"], None, g["probe"], [], 1, g["probe_id"], tables=g["tables"]))
            continue
        body, _, kinds = g["template"].rpartition("\n--kinds:")
        text, slots = body, []
        for k, (slot, kind) in enumerate(zip(g["slots"] or [], kinds.split(",") if kinds else [])):
            spark_type = _slot_type(kind)
            if slot["varies"] and spark_type is not None and not cuts:
                text = text.replace(f"{MARK}{k}{MARK}", f"__params.__p{k}")
                slots.append((k, spark_type))
            elif not slot["varies"]:
                text = text.replace(f"{MARK}{k}{MARK}", slot["raw"])
        members = t.where(F.col("grp") == g["grp"]).select("query_id", "query", "slot_val")
        part = _Part(run, g["grp"], members, text, slots, g["n"], tables=g["tables"])
        try:
            if MARK in text:
                raise ValueError("a slot that varies has to stay a literal")
            part.rows()  # analysis only
        except Exception:  # noqa: BLE001 - not as a parameter: each member by its own text
            for m in members.select("query_id", "query").toLocalIterator():
                add(_Part(run, g["grp"], None, m["query"], [], 1, m["query_id"], tables=g["tables"]))
            continue
        add(part)
    run.write_parts(ready)
    run.flush()

    rows = session.read.schema(ROWS_SCHEMA).parquet(*run.paths) if run.paths else session.createDataFrame([], ROWS_SCHEMA)
    errors = session.read.schema(ERROR_SCHEMA).parquet(*run.error_paths) if run.error_paths else session.createDataFrame([], ERROR_SCHEMA)
    by_group = session.createDataFrame(refused, "grp long, g_error string, g_class string")
    spent = session.createDataFrame(run.seconds, "grp long, seconds double").groupBy("grp").agg(F.max("seconds").alias("seconds"))
    counts = rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    ex = (t.select("query_id", "grp").join(by_group, "grp", "left").join(spent, "grp", "left")
          .join(errors, "query_id", "left").join(counts, "query_id", "left"))
    error, kind = F.coalesce("error", "g_error"), F.coalesce("error_class", "g_class")
    ex = ex.select("query_id", error.isNull().alias("success"), error.alias("error"), kind.alias("error_class"),
                   F.when(error.isNull(), F.coalesce("_n", F.lit(0))).otherwise(0).cast("bigint").alias("row_count"), "seconds")
    ex_path = os.path.join(base, "executions")
    ex.write.parquet(ex_path)  # read by both sides of the comparison
    ex, paths = spark.read.parquet(ex_path), list(run.paths)
    if store is not None:
        store.keep(run_name, ex, run.paths)
        paths += store.rows_of(known)
        kept = known.select("query_id", F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"),
                            F.lit(None).cast("string").alias("error_class"), "row_count", "seconds", F.lit(True).alias("kept"))
        ex = ex.withColumn("kept", F.lit(False)).unionByName(kept)
    return ex, (spark.read.schema(ROWS_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], ROWS_SCHEMA))


_TABLE = r"create\s+(?:temporary\s+|temp\s+)?table\s+(?:if\s+not\s+exists\s+)?[`\"\[]?(\w+)[`\"\]]?"
_TABLE_COLUMNS = _TABLE + r"\s*\(((?:[^()]++|\((?:[^()]++|\([^()]*+\))*+\))*+)\)"
_CONSTRAINTS = ("primary", "foreign", "unique", "check", "constraint", "key", "index", "exclude")


def declared_tables(schema: Column) -> Column:
    """The tables that a schema text creates, as ``name(column,column)``, lower case; ``name`` where it lists no columns."""
    text = F.regexp_replace(F.lower(schema), r"--[^\n]*+|(?s:/\*.*?\*/)", " ")
    names = F.regexp_extract_all(text, F.lit(_TABLE_COLUMNS), F.lit(1))
    bodies = F.regexp_extract_all(text, F.lit(_TABLE_COLUMNS), F.lit(2))

    def columns(body: Column) -> Column:
        flat = F.regexp_replace(F.regexp_replace(body, r"\([^()]*\)", ""), r"\([^()]*\)", "")
        first = F.transform(F.split(flat, ","), lambda x: F.regexp_extract(F.btrim(x, F.lit(WS_CHARS)), r"^[`\"\[]?(\w+)", 1))
        return F.array_join(F.filter(first, lambda x: (x != "") & ~x.isin(*_CONSTRAINTS)), ",")
    listed = F.zip_with(names, bodies, lambda n, b: F.concat(n, F.lit("("), columns(b), F.lit(")")))
    plain = F.array_except(F.regexp_extract_all(text, F.lit(_TABLE), F.lit(1)), names)
    return F.concat(F.array_distinct(listed), plain)


def execute_candidates(spark: SparkSession, texted: DataFrame, keys: list[str], views: Callable[[SparkSession], None],
                       out_dir: str | None = None, store: ExecutionStore | None = None) -> DataFrame:
    """X1 → X2/X3 for scored candidates (output of ``with_sql_columns``).

    Distinct (query, schema) pairs are executed once (D3, keyed by T15; with a ``store``, once in all its
    batches) and see only the tables and columns that their schema declares; every candidate gets ``gen_success, gen_error,
    gen_error_class, gen_seconds, ref_success`` and the comparison of its two result sets.
    Candidates without a schema are not executed.
    """
    from ..functions.schema import execution_key, has_schema
    from ..operators import compare as X
    from ..operators.score import REF, SCHEMA, SQL

    c = texted.drop("gen_success", "gen_error", "gen_error_class", "gen_seconds", "ref_success", "ref_error", "exact_match",
                    "similarity", "gen_rows", "ref_rows")
    c = c.withColumns({"_gk": execution_key(F.col(SQL), F.col(SCHEMA)),
                       "_rk": execution_key(F.col(REF), F.col(SCHEMA))})
    ensure_checkpoint_dir(spark)
    c = c.checkpoint(eager=True)   # the regex projection is used three times below
    with_schema = c.where(has_schema(F.col(SCHEMA)))
    qs = with_schema.select(F.col("_gk").alias("query_id"), F.col(SQL).alias("query"), SCHEMA).unionByName(
        with_schema.select(F.col("_rk").alias("query_id"), F.col(REF).alias("query"), SCHEMA))
    ex, rows = run_query_batch(spark, qs, views, schema=SCHEMA, out_dir=out_dir, store=store)
    g = ex.select(F.col("query_id").alias("_gk"), F.col("success").alias("gen_success"),
                  F.col("error").alias("gen_error"), F.col("error_class").alias("gen_error_class"),
                  F.col("seconds").alias("gen_seconds"), F.col("row_count").alias("gen_rows"))
    r = ex.select(F.col("query_id").alias("_rk"), F.col("success").alias("ref_success"),
                  F.col("error").alias("ref_error"), F.col("row_count").alias("ref_rows"))
    # compare once per distinct (generated, reference) pair; rows move only for
    # pairs that both ran, differ in text and have equal non-zero counts
    pairs = c.select("_gk", "_rk").dropDuplicates().join(g, "_gk", "left").join(r, "_rk", "left").withColumns({
        "gen_success": F.coalesce(F.col("gen_success"), F.lit(False)),
        "ref_success": F.coalesce(F.col("ref_success"), F.lit(False)),
        "gen_rows": F.coalesce(F.col("gen_rows"), F.lit(0)),
        "ref_rows": F.coalesce(F.col("ref_rows"), F.lit(0)),
    })
    # rows move under 16 bytes a pair instead of its two keys
    pairs = pairs.withColumn("_pair", F.unhex(F.md5(F.concat("_gk", "_rk"))))
    same = F.col("_gk") == F.col("_rk")
    need = pairs.where(F.col("gen_success") & F.col("ref_success") & ~same
                       & (F.col("gen_rows") == F.col("ref_rows")) & (F.col("gen_rows") > 0)).select("_gk", "_rk", "_pair")
    long = (need.join(rows.withColumnRenamed("query_id", "_gk"), "_gk").select("_pair", F.lit("gen").alias("side"), "cells")
            .unionByName(need.join(rows.withColumnRenamed("query_id", "_rk"), "_rk")
                         .select("_pair", F.lit("ref").alias("side"), "cells")))
    stats = X.pair_stats(long, ["_pair"], row_col="cells").select("_pair", "inter", "uni")
    out = pairs.join(stats, "_pair", "left").drop("_pair")
    # identical query text: the two result sets are the same set
    inter = F.when(same, F.lit(1)).otherwise(F.col("inter"))
    uni = F.when(same, F.lit(1)).otherwise(F.col("uni"))
    exact, sim = X.match_columns(F.col("gen_success"), F.col("ref_success"), F.col("gen_rows"), F.col("ref_rows"),
                                 inter, uni)
    out = out.withColumns({"exact_match": exact, "similarity": sim}).drop("inter", "uni")
    return c.join(out, ["_gk", "_rk"], "left").drop("_gk", "_rk")
