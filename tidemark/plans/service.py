"""Query service: tenant-scoped access to registered tables.

The caller is authenticated already; the service takes a tenant. Tables
without a tenant column are refused. A statement is parsed and analysed by
Spark, and not run, before it is admitted: every relation in the analysed plan,
subqueries and common table expressions included, must be one of the tenant's
own views, rows written in the statement or a range of numbers. So a name that
reaches another table by whatever detour, ``identifier`` among them, ends at a
relation that is not the tenant's. Functions are admitted by list.
"""

from __future__ import annotations

from py4j.java_gateway import is_instance_of
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.columns import TENANT_COLUMNS, for_tenant

MAX_ROWS = 10_000
DEFAULT_ROWS = 100
#: Functions that a statement may call.
FUNCTIONS = frozenset(
    """abs acos any any_value approx_count_distinct approx_percentile array array_agg array_contains array_distinct array_except array_intersect array_join array_max array_min array_position array_remove
    array_sort array_union arrays_zip asin atan avg bit_and bit_or bool_and bool_or ceil ceiling char_length coalesce collect_list collect_set concat concat_ws contains corr cos count count_if count_min_sketch
    covar_pop covar_samp cume_dist current_date current_timestamp date date_add date_diff date_format date_from_unix_date date_sub date_trunc datediff day dayofmonth dayofweek dayofyear decimal dense_rank double
    element_at endswith every exists exp explode explode_outer expr filter first first_value flatten float floor forall from_json from_unixtime get_json_object greatest hash hour if ifnull in initcap inline
    inline_outer instr int isnan isnotnull isnull json_array_length json_object_keys kurtosis lag last last_day last_value lcase lead least left length levenshtein ln locate log log10 log2 lower lpad ltrim make_date
    map map_entries map_filter map_from_arrays map_keys map_values max max_by md5 mean median min min_by minute mod mode month months_between named_struct next_day not now nth_value ntile nullif nullifzero nvl nvl2
    percent_rank percentile percentile_approx pmod posexplode posexplode_outer position pow power quarter radians range rank regexp_count regexp_extract regexp_extract_all regexp_like regexp_replace regr_slope repeat
    replace reverse right rint rlike round row_number rpad rtrim second sequence sha sha1 sha2 shiftleft shiftright sign signum sin size skewness slice some sort_array split split_part sqrt stack startswith std stddev
    stddev_pop stddev_samp string struct substr substring sum tan timestamp to_date to_json to_timestamp transform translate trim trunc try_add try_cast try_divide try_element_at try_sum try_to_timestamp typeof ucase
    unix_millis unix_seconds unix_timestamp upper var_pop var_samp variance weekday weekofyear when width_bucket window xxhash64 year zeroifnull bigint smallint tinyint boolean binary aggregate reduce zip_with
    + - * / % = == <=> < <= > >= <> != ! & | ^ ~ || and or between like ilike case""".split()
)
#: Leaves of an analysed plan that read nothing.
_EMPTY = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "ResolvedInlineTable", "EmptyRelation"}
#: Expressions that tell about the session or machine, or call code.
_TELLING = {"CurrentUser", "CurrentCatalog", "CurrentDatabase", "SparkVersion", "CallMethodViaReflection", "TryReflect", "InputFileName", "InputFileBlockStart", "InputFileBlockLength", "SparkPartitionID", "MonotonicallyIncreasingID", "GetVariable", "VariableReference", "ScalaUDF", "PythonUDF"}
_LOGICAL = "org.apache.spark.sql.catalyst.plans.logical."


class Forbidden(ValueError):
    """A statement that changes something or reaches beyond the tenant's tables."""


def _each(seq):
    for i in range(seq.size()):
        yield seq.apply(i)


def _name(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _expressions(node):
    stack = list(_each(node.expressions()))
    while stack:
        e = stack.pop()
        yield e
        stack += _each(e.children())


class QueryService:
    def __init__(self, spark: SparkSession, tables: dict[str, str], tenant: str, tenant_columns=TENANT_COLUMNS):
        self.spark, self.tables, self.tenant, self.tenant_columns = spark, tables, tenant, tenant_columns

    def _table(self, session: SparkSession, name: str) -> DataFrame:
        if name not in self.tables:
            raise LookupError(f"unknown table {name!r}")
        return for_tenant(session.read.parquet(self.tables[name]), self.tenant, self.tenant_columns)

    def names(self) -> list[str]:
        return sorted(self.tables)

    def schema(self, name: str) -> list[tuple[str, str]]:
        return self._table(self.spark, name).dtypes

    def query(self, name: str, filters: dict[str, object] | None = None, columns: list[str] | None = None, limit: int = DEFAULT_ROWS) -> DataFrame:
        """Equality and IN filters, some columns, at most ``MAX_ROWS`` rows."""
        if not 0 < limit <= MAX_ROWS:
            raise ValueError(f"limit must be from 1 to {MAX_ROWS}")
        df = self._table(self.spark, name)
        unknown = [c for c in [*(filters or {}), *(columns or [])] if c not in df.columns]
        if unknown:
            raise ValueError(f"unknown columns: {', '.join(unknown)}")
        for c, v in (filters or {}).items():
            df = df.where(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        return (df.select(*columns) if columns else df).limit(limit)

    def sql(self, statement: str, limit: int = MAX_ROWS) -> DataFrame:
        """A query over the registered tables, each filtered to the tenant; capped like :meth:`query`."""
        statement = statement.strip().rstrip(";")
        session = self.spark.newSession()
        session.conf.set("spark.sql.runSQLOnFiles", "false")
        state = session._jsparkSession.sessionState()
        try:
            parsed = state.sqlParser().parsePlan(statement)
        except ParseException as e:
            raise Forbidden(f"not one query: {e}") from e
        self._admit_statement(session, parsed)
        for name in self.tables:  # the views of a new session are these alone
            if name.lower() in statement.lower():
                self._table(session, name).createOrReplaceTempView(name)
        skip = getattr(session._jvm.org.apache.spark.sql.execution, "CommandExecutionMode").SKIP()
        self._admit_relations(state.executePlan(parsed, skip).analyzed())
        return session.sql(statement).limit(min(limit, MAX_ROWS) if limit and limit > 0 else MAX_ROWS)

    def _admit_statement(self, session: SparkSession, plan) -> None:
        """A query, by its parsed plan, that calls listed functions alone."""
        gateway, stack = session.sparkContext._gateway, [plan]
        while stack:
            node = stack.pop()
            name = _name(node)
            if is_instance_of(gateway, node, _LOGICAL + "Command") or is_instance_of(gateway, node, _LOGICAL + "ParsedStatement") or "UnresolvedIdentifier" in name:
                raise Forbidden(f"read-only: {name}")
            if name == "UnresolvedTableValuedFunction" and ".".join(_each(node.name())).lower() not in FUNCTIONS:
                raise Forbidden("table function")
            for e in _expressions(node):
                kind = _name(e)
                if "UnresolvedIdentifier" in kind:
                    raise Forbidden("identifier")
                if kind == "UnresolvedFunction" and ".".join(_each(e.nameParts())).lower() not in FUNCTIONS:
                    raise Forbidden("function " + ".".join(_each(e.nameParts())))
            stack += [*_each(node.children()), *_each(node.subqueries()), *(c for c in _each(node.innerChildren()) if is_instance_of(gateway, c, _LOGICAL + "LogicalPlan"))]

    def _admit_relations(self, plan) -> None:
        """Every relation of the analysed plan is a view of this session, or made of nothing."""
        names, stack = {n.lower() for n in self.tables}, [plan]
        while stack:
            node = stack.pop()
            name = _name(node)
            if name == "View":
                identifier = node.desc().identifier()
                if node.isTempView() and identifier.database().isEmpty() and identifier.table().lower() in names:
                    continue
                raise Forbidden(f"not registered: {identifier.unquotedString()}")
            told = {_name(e) for e in _expressions(node)} & _TELLING
            if told:
                raise Forbidden(", ".join(sorted(told)))
            below = [*_each(node.children()), *_each(node.subqueries())]
            if node.children().isEmpty() and name not in _EMPTY:
                raise Forbidden(f"not registered: {name}")
            stack += below

    @staticmethod
    def rows(df: DataFrame) -> list[dict]:
        """Plain rows of a capped result."""
        return [r.asDict(recursive=True) for r in df.limit(MAX_ROWS).collect()]
