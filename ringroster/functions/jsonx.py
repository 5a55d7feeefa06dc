"""Expressions over JSON text columns. Malformed JSON counts as absent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringroster.functions import ColumnLike, as_column
from ringroster.functions.text import char_after


def json_text(c: ColumnLike, *path: str) -> Column:
    """Value at a key path as text; NULL if absent or JSON null."""
    return F.get_json_object(as_column(c), "$" + "".join(f"['{key}']" for key in path))


def json_is_object(c: ColumnLike, *path: str) -> Column:
    """True where the value at the path is a JSON object, false for any other value,
    NULL if it is absent."""
    value = F.try_variant_get(
        F.try_parse_json(as_column(c)), "$" + "".join(f".{key}" for key in path), "variant"
    )
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def transfer_text(extra: ColumnLike, final_status: ColumnLike) -> Column:
    """Where a call went: transfer type and destination, or the overflow destination."""
    extra, final_status = as_column(extra), as_column(final_status)
    as_object = F.concat(
        json_text(extra, "transferencia", "tipo"),
        F.coalesce(
            F.concat(
                F.lit(": "), F.nullif(json_text(extra, "transferencia", "destino"), F.lit(""))
            ),
            F.lit(""),
        ),
    )
    destination = json_text(extra, "destino")
    as_value = F.concat(
        json_text(extra, "transferencia"),
        F.coalesce(F.concat(F.lit(": "), destination), F.lit("")),
    )
    text = (
        F.when(
            final_status == 201,
            F.when(json_is_object(extra, "transferencia"), as_object).otherwise(as_value),
        )
        .when(final_status == 305, F.concat(F.lit("Destino: "), destination))
        .otherwise("-")
    )
    return F.when(extra.isNotNull(), text)


@dataclass(frozen=True)
class Rating:
    """One rating column and the places it may come from."""

    output: str
    direct_key: str
    survey_key: str
    marker: str
    offset: int


# Rating keys, history markers and the offset of the score behind them.
RATINGS = (
    Rating("ref10", "REF10", "AVALIACAOATENDIMENTO", "AVALIACAO ATENDIMENTO", 23),
    Rating("ref14", "REF14", "AVALIACAOEXPERIENCIA", "AVALIACAO EXPERIENCIA", 24),
    Rating("ref11", "REF11", "AVALIACAORECOMENDACAO", "AVALIACAO RECOMENDACAO (", 24),
    Rating(
        "ref12",
        "REF12",
        "AVALIACAOSOLICITACAORESOLVIDA",
        "AVALIACAO SOLICITACAO RESOLVIDA",
        33,
    ),
)


def json_or_history(
    c: ColumnLike, key: str, history: ColumnLike, marker: str, offset: int
) -> Column:
    """JSON value, else the one-character score written behind `marker` in the history."""
    return F.coalesce(json_text(c, key), char_after(history, marker, offset))


def rating_by_flow(
    rating: Rating,
    flow: ColumnLike,
    fields: ColumnLike,
    history: ColumnLike,
    direct_flow: str,
    survey_flow: str,
) -> Column:
    """Rating of an answered call; which source holds it depends on the IVR flow."""
    flow = as_column(flow)
    return F.when(flow == direct_flow, json_text(fields, rating.direct_key)).when(
        flow == survey_flow,
        json_or_history(fields, rating.survey_key, history, rating.marker, rating.offset),
    )
