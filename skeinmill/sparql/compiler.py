"""From the algebra of a SELECT query to a DataFrame.

Patterns become filters and equi-joins on encoded terms; which physical join and
which filter reaches the scan is left to Catalyst. The compiler only fixes what
Catalyst cannot know: patterns of a group are joined most selective first and
along shared variables, and joins on variables that may be unbound accept null.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinmill.session import cut
from skeinmill.sparql import parser as P
from skeinmill.sparql.terms import Expressions, Value, decode, encode, integer_of, lexical, number, order_key, string_of, term, truth, whole


class Dataset:
    """Quads (g, s, p, o) of encoded terms; g is null in the default graph, which is the union of all."""

    def __init__(self, quads: DataFrame) -> None:
        self.quads, self.spark = quads, quads.sparkSession

    def with_predicate(self, p: str) -> DataFrame:
        """The quads of one encoded predicate."""
        return self.quads.where(F.col("p") == p)

    def triples(self, p: str | None = None) -> DataFrame:
        """(s, p, o) of the default graph, of one encoded predicate or all; rows may repeat."""
        return (self.quads if p is None else self.with_predicate(p)).select("s", "p", "o")

    def scoped(self, graphs: list[str], named: list[str]) -> Dataset:
        only = [*graphs, *named]
        return Dataset(self.quads.where(F.col("g").isin(*["u" + g for g in only]))) if only else self


@dataclass
class Frame:
    """Solutions: a column per variable; ``maybe`` are those that can be unbound."""

    df: DataFrame
    names: list[str]
    maybe: frozenset[str] = frozenset()


def _unit(spark) -> Frame:
    return Frame(spark.range(1).select(), [])


class Compiler:
    def __init__(self, dataset: Dataset) -> None:
        self.data, self.spark = dataset, dataset.spark

    # Joins.
    def _condition(self, a: Frame, b: Frame, shared: list[str]) -> Column:
        on = F.lit(True)
        for n in shared:
            left, right = F.col(n), F.col(f"_r_{n}")
            same = left == right
            if n in a.maybe:
                same = same | left.isNull()
            if n in b.maybe:
                same = same | right.isNull()
            on = on & same
        return on

    def _meet(self, a: Frame, b: Frame, shared: list[str], right: DataFrame, how: str, extra: Column | None = None) -> DataFrame:
        """``a`` joined with ``right`` (the columns of ``b`` set aside) on compatible values of ``shared``.

        A variable that is always bound makes an equi-join. Where none is, rows with all
        of them bound are joined by equality, and only the others, if there are any, with everything.
        """
        on = lambda: self._condition(a, b, shared) if extra is None else self._condition(a, b, shared) & extra
        loose = a.maybe | b.maybe
        if not shared or not set(shared) <= loose:
            return a.df.join(right, on(), how)
        bound = lambda names: reduce(lambda x, y: x & y, [F.col(n).isNotNull() for n in names])
        left, right = cut(a.df), cut(right)
        mine, other = bound(shared), bound([f"_r_{n}" for n in shared])
        open_right = not set(shared).isdisjoint(b.maybe) and not right.where(~other).isEmpty()
        open_left = not set(shared).isdisjoint(a.maybe) and not left.where(~mine).isEmpty()
        if open_right and how != "inner":
            return left.join(right, on(), how)
        equal = reduce(lambda x, y: x & y, [F.col(n) == F.col(f"_r_{n}") for n in shared])
        out = left.where(mine).join(right.where(other) if open_right else right, equal if extra is None else equal & extra, how)
        if open_left:
            out = out.unionByName(left.where(~mine).join(right, on(), how))
        if open_right:
            out = out.unionByName(left.where(mine).join(right.where(~other), on(), how))
        return out

    @staticmethod
    def _aside(b: Frame, shared: list[str]) -> DataFrame:
        return b.df.select(*[F.col(n).alias(f"_r_{n}" if n in shared else n) for n in b.names])

    def join(self, a: Frame, b: Frame) -> Frame:
        if not a.names:
            return b
        if not b.names:
            return a
        shared = [n for n in b.names if n in a.names]
        names = [*a.names, *[n for n in b.names if n not in shared]]
        maybe = frozenset(n for n in names if (n in a.maybe or n not in a.names) and (n in b.maybe or n not in b.names))
        if not shared:
            return Frame(a.df.crossJoin(b.df), names, maybe)
        if not (a.maybe | b.maybe) & set(shared):
            return Frame(a.df.join(b.df, shared).select(*names), names, maybe)
        df = self._meet(a, b, shared, self._aside(b, shared), "inner")
        return Frame(df.select(*[F.coalesce(n, f"_r_{n}").alias(n) if n in shared else F.col(n) for n in names]), names, maybe)

    def optional(self, a: Frame, group: P.Group) -> Frame:
        """A left join; the group's own filters belong to its condition."""
        b = self.elements(group)
        own = [f for f in group.filters if not self._has_exists(f) and self._names(f) <= set(b.names)]
        rest = [f for f in group.filters if f not in own]
        for f in own:
            b = self.filter(b, f)
        shared = [n for n in b.names if n in a.names]
        names = [*a.names, *[n for n in b.names if n not in shared]]
        maybe = a.maybe | set(b.names) - set(a.names)
        if not a.names:
            return Frame(self.spark.range(1).join(b.df, F.lit(True), "left").select(*b.names), b.names, frozenset(b.names))
        on = None
        if rest:
            bound = lambda n: F.coalesce(n, f"_r_{n}") if n in shared else F.col(n) if n in names else F.lit(None).cast("string")
            on = self._all_true(rest, bound)
        df = self._meet(a, b, shared, self._aside(b, shared), "left", on)
        return Frame(df.select(*[F.coalesce(n, f"_r_{n}").alias(n) if n in shared and n in a.maybe else F.col(n) for n in names]), names, frozenset(maybe))

    def _all_true(self, filters: list, bound) -> Column | None:
        tests = [F.coalesce(truth(Expressions(bound, self._no_exists).value(f)), F.lit(False)) for f in filters]
        return reduce(lambda x, y: x & y, tests) if tests else None

    @staticmethod
    def _no_exists(_):
        raise P.SparqlError("EXISTS is not answered in an OPTIONAL's filter over outer variables")

    def minus(self, a: Frame, b: Frame) -> Frame:
        shared = [n for n in b.names if n in a.names]
        if not shared:
            return a
        if len(shared) == 1:
            # What is unbound on either side is never equal, and never removes.
            return Frame(a.df.join(self._aside(b, shared).select(f"_r_{shared[0]}"), F.col(shared[0]) == F.col(f"_r_{shared[0]}"), "left_anti"), a.names, a.maybe)
        on = self._condition(a, b, shared)
        if (a.maybe | b.maybe) & set(shared):
            both = F.lit(False)
            for n in shared:
                both = both | (F.col(n).isNotNull() & F.col(f"_r_{n}").isNotNull())
            on = on & both
        return Frame(a.df.join(self._aside(b, shared).select(*[f"_r_{n}" for n in shared]), on, "left_anti"), a.names, a.maybe)

    # Filters.
    def _names(self, e) -> set[str]:
        if isinstance(e, P.Var):
            return {e.name}
        if isinstance(e, P.Exists):
            return set()
        return set().union(*map(self._names, e.args)) if isinstance(e, P.Call) and e.args else set()

    def _has_exists(self, e) -> bool:
        return isinstance(e, P.Exists) or (isinstance(e, P.Call) and any(map(self._has_exists, e.args)))

    def _bound(self, frame: Frame):
        return lambda n: F.col(n) if n in frame.names else F.lit(None).cast("string")

    def filter(self, frame: Frame, e) -> Frame:
        if isinstance(e, P.Call) and e.name == "&&":
            return self.filter(self.filter(frame, e.args[0]), e.args[1])
        if isinstance(e, P.Call) and e.name == "!" and isinstance(e.args[0], P.Exists):
            e = P.Exists(e.args[0].group, not e.args[0].negated)
        if isinstance(e, P.Exists):
            return Frame(self._matched(frame, e.group, "left_anti" if e.negated else "left_semi"), frame.names, frame.maybe)
        marks: list[str] = []
        df = [frame.df]

        def mark(x: P.Exists) -> Column:
            name = f"_e{len(marks)}"
            marks.append(name)
            # Written once, so that both sides of the join below see the same numbers.
            rows = cut(df[0].withColumn("_id", F.monotonically_increasing_id()))
            hit = self._matched(Frame(rows, [*frame.names, "_id"], frame.maybe), x.group, "left_semi").select("_id", F.lit(True).alias(name))
            df[0] = rows.join(hit, "_id", "left").drop("_id").withColumn(name, F.coalesce(name, F.lit(False)))
            return ~F.col(name) if x.negated else F.col(name)

        test = truth(Expressions(self._bound(frame), mark).value(e))
        return Frame(df[0].where(test).select(*frame.names), frame.names, frame.maybe)

    def _matched(self, a: Frame, group: P.Group, how: str) -> DataFrame:
        b = self.elements(group)
        own = [f for f in group.filters if self._has_exists(f) or self._names(f) <= set(b.names)]
        for f in own:
            b = self.filter(b, f)
        rest = [f for f in group.filters if f not in own]
        shared = [n for n in b.names if n in a.names]
        bound = lambda n: F.col(f"_r_{n}") if n in shared else F.col(n) if n in [*a.names, *b.names] else F.lit(None).cast("string")
        right = self._aside(b, shared) if b.names else b.df
        if not rest and shared:
            right = right.select(*[f"_r_{n}" for n in shared]).distinct()
        return self._meet(a, b, shared, right, how, self._all_true(rest, bound))

    # Patterns.
    def _rows(self, graph, p=None) -> DataFrame:
        if graph is None:
            return self.data.triples(encode(p) if isinstance(p, P.Iri) else None)
        q = self.data.with_predicate(encode(p)) if isinstance(p, P.Iri) else self.data.quads
        if isinstance(graph, P.Iri):
            return q.where(F.col("g") == encode(graph)).select("s", "p", "o")
        return q.where(F.col("g").isNotNull()).select("g", "s", "p", "o")

    def _pick(self, rows: DataFrame, parts: list[tuple[str, object]]) -> Frame:
        """Filters by constants and repeated variables, distinct solutions of the variables."""
        first: dict[str, str] = {}
        for col, x in parts:
            if isinstance(x, P.Var):
                if x.name in first:
                    rows = rows.where(F.col(col) == F.col(first[x.name]))
                else:
                    first[x.name] = col
            else:
                rows = rows.where(F.col(col) == encode(x))
        names = list(first)
        if not names:
            return Frame(rows.select(F.lit("s").alias("_true")).limit(1), ["_true"])
        # A triple in several graphs is one triple.
        return Frame(rows.distinct().select(*[F.col(first[n]).alias(n) for n in names]), names)

    def triple(self, t: P.Triple, graph) -> Frame:
        g = [("g", graph)] if isinstance(graph, P.Var) else []
        if isinstance(t.p, P.Path):
            pairs = self.path(t.p, graph, None if isinstance(t.s, P.Var) else encode(t.s), None if isinstance(t.o, P.Var) else encode(t.o))
            frame = self._pick_all(pairs, [*g, ("s", t.s), ("o", t.o)])
            return frame
        return self._pick(self._rows(graph, t.p), [*g, ("s", t.s), ("p", t.p), ("o", t.o)])

    def _pick_all(self, rows: DataFrame, parts) -> Frame:
        first: dict[str, str] = {}
        for col, x in parts:
            if not isinstance(x, P.Var):
                rows = rows.where(F.col(col) == encode(x))
            elif x.name in first:
                rows = rows.where(F.col(col) == F.col(first[x.name]))
            else:
                first[x.name] = col
        if not first:
            return Frame(rows.select(F.lit("s").alias("_true")).limit(1), ["_true"])
        return Frame(rows.select(*[F.col(c).alias(n) for n, c in first.items()]), list(first))

    def path(self, p, graph, s: str | None = None, o: str | None = None) -> DataFrame:
        """(s, o), with g where the graph is a variable; ``s`` and ``o`` start closures from a constant end."""
        keys = ["g"] if isinstance(graph, P.Var) else []
        if isinstance(p, P.Iri):
            return self._rows(graph, p).select(*keys, "s", "o").distinct()
        if p.op == "!":
            forward = [encode(x) for x in p.parts if isinstance(x, P.Iri)]
            back = [encode(x.parts[0]) for x in p.parts if not isinstance(x, P.Iri)]
            rows = self._rows(graph).distinct()
            out = rows.where(~F.col("p").isin(*forward)).select(*keys, "s", "o") if forward or not back else None
            if back:
                reverse = rows.where(~F.col("p").isin(*back)).select(*keys, F.col("o").alias("s"), F.col("s").alias("o"))
                out = reverse if out is None else out.unionByName(reverse)
            return out
        if p.op == "^":
            return self.path(p.parts[0], graph, o, s).select(*keys, F.col("o").alias("s"), F.col("s").alias("o"))
        if p.op == "|":
            out = self.path(p.parts[0], graph, s, o)
            for x in p.parts[1:]:
                out = out.unionByName(self.path(x, graph, s, o))
            return out
        if p.op == "/":
            out = self.path(p.parts[0], graph, s, None)
            for k, x in enumerate(p.parts[1:], 2):
                step = self.path(x, graph, None, o if k == len(p.parts) else None).select(*keys, F.col("s").alias("_m"), F.col("o").alias("_o"))
                out = out.withColumnRenamed("o", "_m").join(step, [*keys, "_m"]).select(*keys, "s", F.col("_o").alias("o"))
            return out
        step = self.path(p.parts[0], graph)
        if p.op in "*+":
            step = self._closure(step, keys, s, o)
        if p.op == "+":
            return step
        return step.unionByName(self._self(graph, keys, s or o)).distinct()

    def _self(self, graph, keys: list[str], constant: str | None) -> DataFrame:
        rows = self._rows(graph)
        nodes = rows.select(*keys, "s").union(rows.select(*keys, F.col("o").alias("s"))).distinct()
        if constant is not None and not keys:
            nodes = self.spark.range(1).select(F.lit(constant).alias("s"))
        return nodes.withColumn("o", F.col("s"))

    def _closure(self, step: DataFrame, keys: list[str], s: str | None, o: str | None) -> DataFrame:
        """All pairs linked by one or more steps; only new pairs are extended in each round, so cycles end.

        Between free ends new pairs are extended by all known ones, which doubles the
        length reached in each round; from a constant end they are extended by steps.
        """
        step = cut(step.distinct())
        new = step.where(F.col("s") == s) if s is not None else step.where(F.col("o") == o) if o is not None else step
        known = new = cut(new)
        back = s is None and o is not None
        while not new.isEmpty():
            if back:
                more = step.withColumnRenamed("o", "_m").join(new.select(*keys, F.col("s").alias("_m"), "o"), [*keys, "_m"]).select(*keys, "s", "o")
            else:
                onward = known if s is None else step
                more = new.withColumnRenamed("o", "_m").join(onward.select(*keys, F.col("s").alias("_m"), "o"), [*keys, "_m"]).select(*keys, "s", "o")
            new = cut(more.distinct().join(known, [*keys, "s", "o"], "left_anti"))
            known = cut(known.unionByName(new))
        return known

    def bgp(self, triples: list[P.Triple], graph) -> Frame:
        """Patterns joined greedily: most constants first, then whatever shares a variable."""
        def weight(t: P.Triple) -> int:
            if isinstance(t.p, P.Path):
                return 1 + 2 * (not isinstance(t.s, P.Var)) + 2 * (not isinstance(t.o, P.Var))
            typed = isinstance(t.p, P.Iri) and t.p.value == P.RDF_TYPE
            return 8 * (not isinstance(t.s, P.Var)) + (2 if typed else 6) * (not isinstance(t.o, P.Var)) + 1 * (not isinstance(t.p, P.Var))

        names = lambda t: {x.name for x in (t.s, t.p, t.o, graph) if isinstance(x, P.Var)}
        left, out = sorted(triples, key=weight, reverse=True), None
        while left:
            at = next((k for k, t in enumerate(left) if out is None or names(t) & set(out.names)), 0)
            frame = self.triple(left.pop(at), graph)
            out = frame if out is None else self.join(out, frame)
        return out

    def elements(self, group: P.Group, graph=None) -> Frame:
        graph = getattr(self, "graph", None) if graph is None else graph
        frame = _unit(self.spark)
        for e in group.elements:
            if isinstance(e, P.Bgp):
                frame = self.join(frame, self.bgp(e.triples, graph))
            elif isinstance(e, P.Group):
                frame = self.join(frame, self.group(e))
            elif isinstance(e, P.Select):
                frame = self.join(frame, self.query(e))
            elif isinstance(e, P.Optional):
                frame = self.optional(frame, e.group)
            elif isinstance(e, P.Minus):
                frame = self.minus(frame, self.group(e.group))
            elif isinstance(e, P.Union):
                frame = self.join(frame, self.union([self.group(x) for x in e.parts]))
            elif isinstance(e, P.GraphBlock):
                before, self.graph = getattr(self, "graph", None), e.name
                inner = self.group(e.group)
                self.graph = before
                frame = self.join(frame, inner)
            elif isinstance(e, P.Bind):
                if e.var in frame.names:
                    raise P.SparqlError(f"?{e.var} is bound already")
                v = term(Expressions(self._bound(frame), self._no_exists).value(e.expr))
                df = frame.df if frame.names else self.spark.range(1).select()
                frame = Frame(df.withColumn(e.var, v), [*frame.names, e.var], frame.maybe | {e.var})
            elif isinstance(e, P.Values):
                frame = self.join(frame, self.values(e))
        return frame

    def group(self, group: P.Group) -> Frame:
        frame = self.elements(group)
        for f in group.filters:
            frame = self.filter(frame, f)
        return frame

    def union(self, frames: list[Frame]) -> Frame:
        names = list(dict.fromkeys(n for f in frames for n in f.names))
        df = None
        for f in frames:
            part = f.df.select(*[F.col(n) if n in f.names else F.lit(None).cast("string").alias(n) for n in names])
            df = part if df is None else df.unionByName(part)
        return Frame(df, names, frozenset(n for n in names if any(n not in f.names or n in f.maybe for f in frames)))

    def values(self, v: P.Values) -> Frame:
        schema = ", ".join(f"`{n}` string" for n in v.names)
        rows = [tuple(None if x is None else encode(x) for x in row) for row in v.rows]
        return Frame(self.spark.createDataFrame(rows, schema), v.names, frozenset(n for k, n in enumerate(v.names) if any(r[k] is None for r in rows)))

    # SELECT.
    def query(self, q: P.Select) -> Frame:
        scoped = self if not (q.from_ or q.from_named) else Compiler(self.data.scoped(q.from_, q.from_named))
        frame = scoped.group(q.where)
        if q.values:
            frame = self.join(frame, self.values(q.values))
        items = [(n, P.Var(n)) for n in frame.names if not n.startswith("_")] if q.star else [(n, P.Var(n) if e is None else e) for n, e in q.items]
        grouped = bool(q.group_by) or any(map(self._has_aggregate, [*[e for _, e in items], *q.having, *[e for e, _ in q.order_by]]))
        if grouped:
            frame, items, having, order = self.aggregate(frame, q, items)
            for h in having:
                frame = self.filter(frame, h)
        else:
            order = q.order_by
        done: list[str] = []
        for n, e in items:
            if not (isinstance(e, P.Var) and e.name == n):
                frame = Frame(frame.df.withColumn(n, term(Expressions(self._bound(frame), self._no_exists).value(e))), [*[x for x in frame.names if x != n], n], frame.maybe | {n})
            elif n not in frame.names:
                frame = Frame(frame.df.withColumn(n, F.lit(None).cast("string")), [*frame.names, n], frame.maybe | {n})
            done.append(n)
        df, keys = frame.df, []
        for e, down in order:
            k = order_key(term(Expressions(self._bound(frame), self._no_exists).value(e)))
            keys.append(k.desc() if down else k.asc())
        if keys and q.distinct:
            # Keys of variables that are not selected cannot order distinct rows.
            df = df.select(*done).distinct()
        if keys:
            # Ties are broken by the selected variables, so that LIMIT is repeatable.
            df = df.orderBy(*keys, *[order_key(F.col(n)).asc() for n in done])
        df = df.select(*done)
        if q.distinct and not keys:
            df = df.distinct()
        if q.offset:
            df = df.offset(q.offset)
        if q.limit is not None:
            df = df.limit(q.limit)
        return Frame(df, done, frame.maybe & set(done))

    def _has_aggregate(self, e) -> bool:
        return isinstance(e, P.Call) and (e.name in P.AGGREGATES or any(map(self._has_aggregate, e.args)))

    def aggregate(self, frame: Frame, q: P.Select, items):
        keys = []
        df = frame.df
        for n, e in q.group_by:
            v = term(Expressions(self._bound(frame), self._no_exists).value(e))
            df = df.withColumn(f"_k_{n}", v)
            keys.append(n)
        found: dict[str, Column] = {}
        inner = Expressions(self._bound(frame), self._no_exists)

        def lift(e):
            if isinstance(e, P.Call) and e.name in P.AGGREGATES:
                name = f"_a{len(found)}"
                found[name] = self._one(inner, e)
                return P.Var(name)
            if isinstance(e, P.Call):
                return P.Call(e.name, [lift(x) for x in e.args], e.distinct, e.sep)
            return e

        items = [(n, lift(e)) for n, e in items]
        named = {n: e for n, e in items}
        swap = lambda e: named[e.name] if isinstance(e, P.Var) and e.name in named and not (isinstance(named[e.name], P.Var) and named[e.name].name == e.name) else P.Call(e.name, [swap(x) for x in e.args], e.distinct, e.sep) if isinstance(e, P.Call) else e
        having = [swap(lift(e)) for e in q.having]
        order = [(lift(e), down) for e, down in q.order_by]
        aggs = [c.alias(n) for n, c in found.items()] or [F.count(F.lit(1)).alias("_none")]
        out = df.groupBy(*[f"_k_{n}" for n in keys]).agg(*aggs).select(*[F.col(f"_k_{n}").alias(n) for n in keys], *found)
        names = [*keys, *found]
        return Frame(out, names, frozenset(names)), items, having, order

    def _one(self, ex: Expressions, e: P.Call) -> Column:
        """An aggregate as an encoded term."""
        if not e.args:
            if e.distinct:
                raise P.SparqlError("COUNT(DISTINCT *) is not answered")
            return integer_of(F.count(F.lit(1)))
        v = ex.value(e.args[0])
        t = term(v)
        if e.name == "COUNT":
            return integer_of(F.count_distinct(t) if e.distinct else F.count(t))
        if e.name in ("MIN", "MAX"):
            pick = F.min if e.name == "MIN" else F.max
            return pick(F.when(t.isNotNull(), order_key(t)))["term"]
        if e.name == "SAMPLE":
            return F.min(t)
        if e.name == "GROUP_CONCAT":
            items = F.collect_set(lexical(t)) if e.distinct else F.collect_list(lexical(t))
            return string_of(F.array_join(F.array_sort(items), e.sep))
        n = number(Value(t, "term"))
        if e.distinct:
            total = F.aggregate(F.collect_set(n), F.lit(0.0), lambda acc, x: acc + x)
            count = F.count_distinct(n)
        else:
            total, count = F.coalesce(F.sum(n), F.lit(0.0)), F.count(n)
        if e.name == "SUM":
            # One operand that is no number makes the sum an error.
            good = F.count(t) == F.count(n)
            return F.when(good, term(Value(total, "num", F.coalesce(F.bool_and(whole(Value(t, "term"))), F.lit(True)))))
        return F.when(count == 0, F.lit("i0")).otherwise(F.concat(F.lit("d"), (total / count).cast("string")))


def solutions(dataset: Dataset, query: str | P.Select, prefixes: dict[str, str] | None = None) -> DataFrame:
    """The solutions of a SELECT query as encoded terms, a column per selected variable, null where unbound."""
    q = P.parse(query, prefixes) if isinstance(query, str) else query
    return Compiler(dataset).query(q).df


def select(dataset: Dataset, query: str | P.Select, prefixes: dict[str, str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """The solutions with the text of each term, cast to ``types`` where a variable's type is known."""
    df = solutions(dataset, query, prefixes)
    types = types or {}
    return df.select(*[lexical(F.col(c)).try_cast(types[c]).alias(c) if c in types else lexical(F.col(c)).alias(c) for c in df.columns])


def rows(df: DataFrame, limit: int = 1_000) -> list[dict]:
    """At most ``limit`` solutions as dicts of Python values without unbound variables, to be shown."""
    return [{k: decode(v) for k, v in r.asDict().items() if v is not None} for r in df.limit(limit).collect()]
