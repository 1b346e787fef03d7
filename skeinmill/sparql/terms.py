"""RDF terms as single strings, and SPARQL expressions over them as columns.

A term is one character for its kind and its text, so that equal terms are equal
strings and joins need no structs: u IRI, s plain string, i integer, d decimal,
f double, b boolean, l language tag + SOH + text, t datatype + SOH + text. An
unbound variable and an expression error are both null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinmill.sparql.parser import XSD, Call, Exists, Iri, Lit, SparqlError, Var

SOH = "\u0001"
_KINDS = {XSD + "integer": "i", XSD + "int": "i", XSD + "long": "i", XSD + "nonNegativeInteger": "i", XSD + "decimal": "d", XSD + "double": "f", XSD + "float": "f", XSD + "boolean": "b", XSD + "string": "s", "": "s"}
_TYPES = {"i": XSD + "integer", "d": XSD + "decimal", "f": XSD + "double", "b": XSD + "boolean", "s": XSD + "string"}


def encode(term: Iri | Lit) -> str:
    if isinstance(term, Iri):
        return "u" + term.value
    if term.lang:
        return f"l{term.lang}{SOH}{term.lex}"
    kind = _KINDS.get(term.dt)
    return f"{kind}{term.lex}" if kind else f"t{term.dt}{SOH}{term.lex}"


def decode(text: str | None):
    """The Python value of an encoded term."""
    if text is None:
        return None
    kind, body = text[0], text[1:]
    if kind in "lt":
        return body.partition(SOH)[2]
    return {"i": int, "d": float, "f": float, "b": lambda x: x == "true"}.get(kind, str)(body)


def iri_of(col: Column) -> Column:
    return F.concat(F.lit("u"), col)


def string_of(col: Column) -> Column:
    return F.concat(F.lit("s"), col)


def integer_of(col: Column) -> Column:
    return F.concat(F.lit("i"), col.cast("bigint").cast("string"))


@dataclass
class Value:
    """A column with what is known of it: kind ``term``, ``num`` (double, ``whole`` tells integers), ``str`` or ``bool``."""

    col: Column
    kind: str
    whole: Column | None = None


def kind_of(col: Column) -> Column:
    return F.substring(col, 1, 1)


def lexical(col: Column) -> Column:
    tagged = kind_of(col).isin("l", "t")
    return F.when(tagged, F.regexp_replace(col, "(?s)^[^\u0001]*\u0001", "")).otherwise(F.substring(col, F.lit(2), F.length(col)))


def number(v: Value) -> Column:
    if v.kind == "num":
        return v.col
    if v.kind == "term":
        return F.when(kind_of(v.col).isin("i", "d", "f"), lexical(v.col).try_cast("double"))
    return F.lit(None).cast("double")


def whole(v: Value) -> Column:
    if v.kind == "num":
        return v.whole if v.whole is not None else F.lit(False)
    return F.coalesce(kind_of(v.col) == "i", F.lit(False)) if v.kind == "term" else F.lit(False)


def text(v: Value) -> Column:
    if v.kind == "str":
        return v.col
    if v.kind == "term":
        return lexical(v.col)
    if v.kind == "bool":
        return v.col.cast("string")
    return lexical(term(v))


def truth(v: Value) -> Column:
    if v.kind == "bool":
        return v.col
    if v.kind == "num":
        return v.col != 0
    if v.kind == "str":
        return v.col != ""
    k = kind_of(v.col)
    return F.when(k == "b", lexical(v.col) == "true").when(k.isin("i", "d", "f"), number(v) != 0).when(k.isin("s", "l"), lexical(v.col) != "")


def term(v: Value) -> Column:
    if v.kind == "term":
        return v.col
    if v.kind == "str":
        return string_of(v.col)
    if v.kind == "bool":
        return F.concat(F.lit("b"), v.col.cast("string"))
    return F.when(whole(v), F.concat(F.lit("i"), v.col.cast("decimal(38,0)").cast("string"))).otherwise(F.concat(F.lit("f"), v.col.cast("string")))


def order_key(col: Column) -> Column:
    """Unbound, IRIs, numbers by value, then other literals by text."""
    k = kind_of(col)
    rank = F.when(col.isNull(), 0).when(k == "u", 1).when(k.isin("i", "d", "f"), 2).otherwise(3)
    return F.struct(rank.alias("rank"), number(Value(col, "term")).alias("num"), F.coalesce(lexical(col), F.lit("")).alias("lex"), F.coalesce(col, F.lit("")).alias("term"))


def _number(col: Column, is_whole: Column | bool = False) -> Value:
    return Value(col.cast("double"), "num", F.lit(is_whole) if isinstance(is_whole, bool) else is_whole)


def _equal(a: Value, b: Value) -> Column:
    if "num" in (a.kind, b.kind):
        return number(a) == number(b)
    if "bool" in (a.kind, b.kind):
        return truth(a) == truth(b)
    ta, tb = term(a), term(b)
    na, nb = number(Value(ta, "term")), number(Value(tb, "term"))
    if a.kind == "str" or b.kind == "str":
        return ta == tb
    return F.when(na.isNotNull() & nb.isNotNull(), na == nb).otherwise(ta == tb)


def _less(a: Value, b: Value, op: str) -> Column:
    compare = {"<": lambda x, y: x < y, "<=": lambda x, y: x <= y, ">": lambda x, y: x > y, ">=": lambda x, y: x >= y}[op]
    if "num" in (a.kind, b.kind):
        return compare(number(a), number(b))
    ta, tb = term(a), term(b)
    ka, kb = kind_of(ta), kind_of(tb)
    na, nb = number(Value(ta, "term")), number(Value(tb, "term"))
    same = (ka == kb) & ~ka.isin("u", "i", "d", "f")
    return F.when(na.isNotNull() & nb.isNotNull(), compare(na, nb)).when(same, compare(lexical(ta), lexical(tb)))


class Expressions:
    """Evaluates expressions over a frame's columns; ``refs`` replaces whole sub-expressions by columns."""

    def __init__(self, bound, exists=None) -> None:
        self.bound, self.exists = bound, exists

    def value(self, e) -> Value:
        if isinstance(e, Var):
            return Value(self.bound(e.name), "term")
        if isinstance(e, (Iri, Lit)):
            v = encode(e)
            if v[0] in "idf":
                return _number(F.lit(float(v[1:])), v[0] == "i")
            return Value(F.lit(v), "term")
        if isinstance(e, Value):
            return e
        if isinstance(e, Exists):
            return Value(self.exists(e), "bool")
        if isinstance(e, Call):
            return self.call(e)
        raise SparqlError(f"cannot evaluate {e!r}")

    def call(self, e: Call) -> Value:
        name = e.name
        if name in ("&&", "||"):
            a, b = truth(self.value(e.args[0])), truth(self.value(e.args[1]))
            return Value(a & b if name == "&&" else a | b, "bool")
        if name == "IN":
            out, first = F.lit(False), self.value(e.args[0])
            for x in e.args[1:]:
                out = out | _equal(first, self.value(x))
            return Value(out, "bool")
        if name == "BOUND":
            return Value(self.bound(e.args[0].name).isNotNull(), "bool")
        if name == "COALESCE":
            return Value(F.coalesce(*[term(self.value(x)) for x in e.args]), "term")
        args = [self.value(x) for x in e.args]
        f = getattr(self, "f_" + name.lower(), None) if name.isidentifier() else None
        if name in _OPERATORS:
            return _OPERATORS[name](*args)
        if f:
            return f(*args)
        if name.startswith(XSD):
            return _cast(name, args[0])
        raise SparqlError(f"unknown function {name}")

    # Terms.
    def f_if(self, c, a, b):
        return Value(F.when(truth(c), term(a)).when(~truth(c), term(b)), "term")

    def f_str(self, a):
        return Value(text(a), "str")

    def f_lang(self, a):
        t = term(a)
        return Value(F.when(kind_of(t) == "l", F.substring_index(F.substring(t, F.lit(2), F.length(t)), SOH, 1)).when(kind_of(t) != "u", ""), "str")

    def f_langmatches(self, a, b):
        have, want = F.lower(text(a)), F.lower(text(b))
        return Value(F.when(want == "*", have != "").otherwise((have == want) | have.startswith(F.concat(want, F.lit("-")))), "bool")

    def f_datatype(self, a):
        t = term(a)
        out = F.when(kind_of(t) == "t", F.substring_index(F.substring(t, F.lit(2), F.length(t)), SOH, 1)).when(kind_of(t) == "l", F.lit("http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"))
        for k, dt in _TYPES.items():
            out = out.when(kind_of(t) == k, dt)
        return Value(iri_of(out), "term")

    def f_isiri(self, a):
        return Value(kind_of(term(a)) == "u", "bool")

    f_isuri = f_isiri

    def f_isliteral(self, a):
        return Value(kind_of(term(a)) != "u", "bool")

    def f_isblank(self, a):
        return Value(term(a).isNull() & F.lit(None).cast("boolean"), "bool")

    def f_isnumeric(self, a):
        return Value(F.when(term(a).isNotNull(), number(a).isNotNull()), "bool")

    def f_sameterm(self, a, b):
        return Value(term(a) == term(b), "bool")

    def f_iri(self, a):
        return Value(iri_of(text(a)), "term")

    f_uri = f_iri

    def f_strdt(self, a, b):
        dt = text(b)
        out = F.concat(F.lit("t"), dt, F.lit(SOH), text(a))
        for iri, k in _KINDS.items():
            if iri:
                out = F.when(dt == iri, F.concat(F.lit(k), text(a))).otherwise(out)
        return Value(out, "term")

    def f_strlang(self, a, b):
        return Value(F.concat(F.lit("l"), F.lower(text(b)), F.lit(SOH), text(a)), "term")

    # Strings.
    def f_strlen(self, a):
        return _number(F.length(text(a)), True)

    def f_substr(self, a, start, n=None):
        t, s = text(a), number(start).cast("int")
        return Value(F.substring(t, s, number(n).cast("int") if n else F.greatest(F.length(t), F.lit(1))), "str")

    def f_ucase(self, a):
        return Value(F.upper(text(a)), "str")

    def f_lcase(self, a):
        return Value(F.lower(text(a)), "str")

    def f_strstarts(self, a, b):
        return Value(text(a).startswith(text(b)), "bool")

    def f_strends(self, a, b):
        return Value(text(a).endswith(text(b)), "bool")

    def f_contains(self, a, b):
        return Value(text(a).contains(text(b)), "bool")

    def f_strbefore(self, a, b):
        at = F.call_function("instr", text(a), text(b))
        return Value(F.when(at > 0, F.substring(text(a), F.lit(1), at - 1)).otherwise(F.when(text(a).isNotNull(), "")), "str")

    def f_strafter(self, a, b):
        at = F.call_function("instr", text(a), text(b))
        return Value(F.when(at > 0, F.substring(text(a), at + F.length(text(b)), F.length(text(a)) + 1)).otherwise(F.when(text(a).isNotNull(), "")), "str")

    def f_concat(self, *args):
        return Value(F.concat(*[text(a) for a in args]) if args else F.lit(""), "str")

    def _flags(self, pattern: Value, flags: Value | None) -> Column:
        if flags is None:
            return text(pattern)
        return F.concat(F.lit("(?"), text(flags), F.lit(")"), text(pattern))

    def f_regex(self, a, p, flags=None):
        return Value(F.call_function("rlike", text(a), self._flags(p, flags)), "bool")

    def f_replace(self, a, p, to, flags=None):
        return Value(F.regexp_replace(text(a), self._flags(p, flags), text(to)), "str")

    def f_encode_for_uri(self, a):
        return Value(F.replace(F.replace(F.replace(F.url_encode(text(a)), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")), "str")

    # Numbers.
    def f_abs(self, a):
        return _number(F.abs(number(a)), whole(a))

    def f_round(self, a):
        return _number(F.floor(number(a) + 0.5), whole(a))

    def f_ceil(self, a):
        return _number(F.ceil(number(a)), whole(a))

    def f_floor(self, a):
        return _number(F.floor(number(a)), whole(a))

    def f_rand(self):
        return _number(F.rand())

    # Times.
    def f_now(self):
        return Value(F.concat(F.lit(f"t{XSD}dateTime{SOH}"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")), "term")

    def _part(self, a: Value, group: int) -> Value:
        m = F.regexp_extract(text(a), r"^(-?\d{4})-(\d\d)-(\d\d)(?:T(\d\d):(\d\d):(\d\d(?:\.\d+)?))?(Z|[+-]\d\d:\d\d)?$", group)
        return _number(F.when(m != "", m).try_cast("double"), group < 6)

    def f_year(self, a):
        return self._part(a, 1)

    def f_month(self, a):
        return self._part(a, 2)

    def f_day(self, a):
        return self._part(a, 3)

    def f_hours(self, a):
        return self._part(a, 4)

    def f_minutes(self, a):
        return self._part(a, 5)

    def f_seconds(self, a):
        return self._part(a, 6)

    def f_tz(self, a):
        return Value(F.regexp_extract(text(a), r"(Z|[+-]\d\d:\d\d)$", 1), "str")

    def f_timezone(self, a):
        z = F.regexp_extract(text(a), r"(Z|[+-]\d\d:\d\d)$", 1)
        sign = F.when(z.startswith("-"), "-").otherwise("")
        hours, minutes = F.substring(z, 2, 2).try_cast("int"), F.substring(z, 5, 2).try_cast("int")
        span = F.concat(F.when(hours > 0, F.concat(hours, F.lit("H"))).otherwise(""), F.when(minutes > 0, F.concat(minutes, F.lit("M"))).otherwise(""))
        body = F.when((z == "Z") | (span == ""), "PT0S").otherwise(F.concat(sign, F.lit("PT"), span))
        return Value(F.when(z != "", F.concat(F.lit(f"t{XSD}dayTimeDuration{SOH}"), body)), "term")

    # Hashes and new names.
    def f_md5(self, a):
        return Value(F.md5(text(a)), "str")

    def f_sha1(self, a):
        return Value(F.sha1(text(a)), "str")

    def f_sha256(self, a):
        return Value(F.sha2(text(a), 256), "str")

    def f_sha384(self, a):
        return Value(F.sha2(text(a), 384), "str")

    def f_sha512(self, a):
        return Value(F.sha2(text(a), 512), "str")

    def f_uuid(self):
        return Value(F.concat(F.lit("uurn:uuid:"), F.expr("uuid()")), "term")

    def f_struuid(self):
        return Value(F.expr("uuid()"), "str")

    def f_bnode(self, a=None):
        return Value(F.concat(F.lit("u_:"), F.sha1(text(a)) if a else F.expr("uuid()")), "term")


def _arith(f, keeps_whole: bool = True):
    return lambda a, b: _number(f(number(a), number(b)), whole(a) & whole(b) if keeps_whole else False)


_OPERATORS = {
    "=": lambda a, b: Value(_equal(a, b), "bool"),
    "!=": lambda a, b: Value(~_equal(a, b), "bool"),
    "<": lambda a, b: Value(_less(a, b, "<"), "bool"),
    "<=": lambda a, b: Value(_less(a, b, "<="), "bool"),
    ">": lambda a, b: Value(_less(a, b, ">"), "bool"),
    ">=": lambda a, b: Value(_less(a, b, ">="), "bool"),
    "!": lambda a: Value(~truth(a), "bool"),
    "neg": lambda a: _number(-number(a), whole(a)),
    "+": _arith(lambda x, y: x + y),
    "-": _arith(lambda x, y: x - y),
    "*": _arith(lambda x, y: x * y),
    "/": _arith(lambda x, y: F.try_divide(x, y), False),
}


def _cast(dt: str, a: Value) -> Value:
    t = F.trim(text(a))
    kind = _KINDS.get(dt, "t")
    if kind == "i":
        return _number(F.floor(F.abs(t.try_cast("double"))) * F.signum(t.try_cast("double")), True)
    if kind in "df":
        return _number(t.try_cast("double"))
    if kind == "b":
        return Value(F.when(t.isin("true", "1"), True).when(t.isin("false", "0"), False), "bool")
    return Value(text(a), "str") if kind == "s" else Value(F.concat(F.lit(f"t{dt}{SOH}"), t), "term")
