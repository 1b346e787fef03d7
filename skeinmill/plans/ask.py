"""Questions in natural language, answered by a generated SPARQL query."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from skeinmill.operators import census
from skeinmill.operators.graph import NAMESPACES
from skeinmill.session import cut
from skeinmill.sparql import Dataset, SparqlError, parse
from skeinmill.sparql.compiler import rows, solutions
from skeinmill.sparql.parser import iris


class AskError(RuntimeError):
    """A question that got no usable query."""


def clean_query(raw: str, namespaces: dict[str, str] = NAMESPACES) -> str:
    """The query in a model's answer: without fences and talk around it, with prefixes declared (Q-21)."""
    text = re.sub(r"^```\w*\s*|\s*```$", "", raw.strip())
    fenced = re.search(r"```(?:sparql)?\s*(.*?)```", raw, re.S | re.I)
    text = (fenced[1] if fenced else text).strip()
    if not text or text.upper().startswith("UNANSWERABLE"):
        raise AskError("the question cannot be answered from the graph")
    body = "\n".join(x for x in text.split("\n") if not re.match(r"\s*PREFIX\s", x, re.I))
    return "".join(f"PREFIX {k}: <{v}>\n" for k, v in sorted(namespaces.items())) + "\n" + body.strip()


def problems(query: str, vocabulary: set[str], namespaces: dict[str, str] = NAMESPACES) -> list[str]:
    """What is wrong with a query: syntax, or terms of the own namespace that the graph doesn't use (Q-19, Q-20)."""
    try:
        used = iris(parse(query, namespaces))
    except SparqlError as x:
        return [f"syntax: {x}"]
    own = namespaces["pkg"]
    return [f"unknown term {i.removeprefix(own)}" for i in sorted(used) if i.startswith(own) and i.removeprefix(own) not in vocabulary]


def ask(question: str, data: Dataset, entities: DataFrame, relations: DataFrame, llm: Callable[[list[dict]], str], *, examples: list[tuple[str, str]] = (), max_repairs: int = 2, show: int = 1_000, execute: bool = True, namespaces: dict[str, str] = NAMESPACES) -> dict:
    """The report of a question: query, attempts, row_count and the first ``show`` rows.

    A query that fails validation is sent back at most ``max_repairs`` times. One
    without rows is sent back once if none was before; a second one without rows
    is the answer.
    """
    known = {r["term"] for r in census.vocabulary(entities, relations).collect()}
    card = census.schema_card(entities, relations)
    shown = "\n\n".join(f"# {q}\n{text}" for q, text in examples)
    messages = [
        {"role": "system", "content": f"Write one SPARQL SELECT query and nothing else, or UNANSWERABLE.\n{card}\n{shown}".strip()},
        {"role": "user", "content": question},
    ]
    repairs = attempts = 0
    while True:
        answer = llm(messages)
        attempts += 1
        query = clean_query(answer, namespaces)
        wrong = problems(query, known, namespaces)
        if wrong:
            if repairs >= max_repairs:
                raise AskError("; ".join(wrong))
            repairs += 1
            messages += [{"role": "assistant", "content": answer}, {"role": "user", "content": "Correct the query: " + "; ".join(wrong)}]
            continue
        report = {"question": question, "query": query, "attempts": attempts, "executed": execute, "row_count": 0, "rows": []}
        if not execute:
            return report
        answered = cut(solutions(data, query, namespaces))
        n, found = answered.count(), rows(answered, show)
        if not found and not repairs:
            repairs += 1
            messages += [{"role": "assistant", "content": answer}, {"role": "user", "content": "The query gives no rows. Check names and predicates."}]
            continue
        return report | {"row_count": n, "rows": found}
