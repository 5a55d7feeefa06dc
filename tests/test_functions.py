"""Column functions on the edge rows they are defined by."""

import random
from datetime import date, datetime

import pytest
from conftest import evaluate
from dateutil.relativedelta import relativedelta
from pyspark.sql import functions as F

from ringroster.functions import codes, dates, durations, jsonx, scores, text


def test_normalisation_trims_spaces_only(spark):
    got = evaluate(spark, text.norm_upper("s"), ["  ação ", "\tx ", None, ""], "s string")
    assert got == ["AÇÃO", "\tX", None, ""]


def test_scrub_removes_controls_and_turns_nbsp_into_space(spark):
    data = [" ab\tc\r\n ", "a b", None, "\t\r\n"]
    assert evaluate(spark, text.scrub_upper("s"), data, "s string") == ["ABC", "A B", None, ""]


def test_remove_and_left(spark):
    data = ["MICRO TEMA - A.*", "none", None]
    assert evaluate(spark, text.remove_literal("s", "MICRO TEMA - "), data, "s string") == [
        "A.*",
        "none",
        None,
    ]
    assert evaluate(spark, text.left_chars("s", 3), data, "s string") == ["MIC", "non", None]


def test_char_after_marker(spark):
    data = ["xx MARK: 7", "MARK", "none", None]
    assert evaluate(spark, text.char_after("s", "MARK", 6), data, "s string") == [
        "7",
        "",
        None,
        None,
    ]


def test_nth_label_limits(spark):
    got = evaluate(
        spark, text.nth_label(F.lit("a:b"), "n"), [-1, 0, 1, 2, 3, None], "n int"
    )
    assert got == [None, None, "a", "b", "", None]


def test_concat_is_null_propagating_and_labels_skip_nulls(spark):
    data = [("a", "b"), ("a", None), (None, ""), ("a", "")]
    assert evaluate(spark, text.concat_null("x", "y"), data, "x string, y string") == [
        "ab",
        None,
        None,
        "a",
    ]
    shown = text.labelled_fields([(F.lit("n"), "x"), ("x", "y")])
    assert evaluate(spark, shown, data, "x string, y string") == [
        "n: a - a: b",
        "n: a",
        "",
        "n: a",
    ]


def test_key_text(spark):
    assert evaluate(spark, text.key_text("d", True), [7.0, None, float("nan")], "d double") == [
        "7",
        None,
        None,
    ]
    assert evaluate(spark, text.key_text("s"), ["007", None], "s string") == ["007", None]


def test_money_text(spark):
    data = [1234567.5, 0, -3, None]
    plain = text.money_text("d")
    assert evaluate(spark, plain, [float(x) if x is not None else None for x in data], "d double") == [
        "R$1,234,567.5000",
        "R$0.0000",
        "R$-3.0000",
        None,
    ]
    swapped = text.money_text("d", "€", ".", ",")
    assert evaluate(spark, swapped, [1234.5], "d double") == ["€1.234,5000"]


def test_case_rules_are_a_parameter(spark):
    data = ["CLIENT one", "client two", None]
    assert evaluate(spark, text.starts_with("s", "CLIENT"), data, "s string") == [
        True,
        False,
        None,
    ]
    relaxed = text.starts_with("s", "CLIENT", "UTF8_LCASE")
    assert evaluate(spark, relaxed, data, "s string") == [True, True, None]
    assert evaluate(spark, text.icontains("s", "Client"), data, "s string") == [True, True, False]
    assert evaluate(spark, text.upper_in("s", ["CLIENT TWO"]), data, "s string") == [
        False,
        True,
        None,
    ]


def test_day_first_text(spark):
    data = ["31/12/2025", "31/12/2025 10:11:12", "99/99/2025", None, "1/2/2024 25:00:00", "31/02/2024"]
    assert evaluate(spark, dates.dayfirst_to_iso("s"), data, "s string") == [
        "2025-12-31 00:00:00",
        "2025-12-31 10:11:12",
        None,
        None,
        None,
        None,
    ]


def test_day_first_text_in_a_zone_with_gaps(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        day = dates.dayfirst_to_iso("s").substr(1, 10)
        assert evaluate(spark, day, ["04/11/2018"], "s string") == ["2018-11-04"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sla_flag(spark):
    a = datetime(2024, 1, 1, 23, 59)
    data = [
        (a, datetime(2024, 1, 6, 0, 0)),
        (a, datetime(2024, 1, 6, 23, 59, 59)),
        (a, datetime(2024, 1, 7, 0, 0)),
        (a, datetime(2023, 12, 1)),
        (a, None),
        (None, a),
    ]
    flag = dates.within_days_flag("a", "b", 5)
    assert evaluate(spark, flag, data, "a timestamp_ntz, b timestamp_ntz") == [1, 1, 0, 1, 0, 0]


def test_day_plus_seconds(spark):
    got = evaluate(
        spark,
        dates.stamp_iso(dates.day_plus_seconds("d", "s")),
        [(date(2024, 2, 29), 3661), (date(2024, 2, 29), None), (None, 1)],
        "d date, s bigint",
    )
    assert got == ["2024-02-29 01:01:01", None, None]


def test_parts_of_dates(spark):
    data = [datetime(2024, 3, 3, 5, 6, 7), None]

    def got(c):
        return evaluate(spark, c, data, "t timestamp_ntz")

    assert got(dates.weekday_num("t")) == [1, None]
    assert got(dates.year_text("t")) == ["2024", None]
    assert got(dates.month_num("t")) == [3, None]
    assert got(dates.month_abbr("t")) == ["Mar", None]
    assert got(dates.stamp_text("t")) == ["03/03/2024 05:06:07", None]
    assert got(dates.date_text("t")) == ["03/03/2024", None]
    assert got(dates.month_start("t")) == [date(2024, 3, 1), None]


def test_parse_date_tolerates_bad_text(spark):
    data = ["2024-02-30", "2024-02-29", "x", None, "2024-02-29 10:00:00"]
    assert evaluate(spark, dates.parse_date("s"), data, "s string") == [
        None,
        date(2024, 2, 29),
        None,
        None,
        date(2024, 2, 29),
    ]
    first = dates.parse_date("s", "dd/MM/yyyy")
    assert evaluate(spark, first, ["29/02/2024", "02/29/2024"], "s string") == [
        date(2024, 2, 29),
        None,
    ]


def test_age_turns_on_the_birthday(spark):
    data = [
        (date(2000, 6, 15), date(2024, 6, 15)),
        (date(2000, 6, 16), date(2024, 6, 15)),
        (date(2000, 2, 29), date(2023, 2, 28)),
        (None, date(2024, 1, 1)),
    ]
    assert evaluate(spark, dates.age_years("b", "a"), data, "b date, a date") == [24, 23, 22, None]


def test_tenure_agrees_with_dateutil(spark):
    rng = random.Random(7)
    start = date(1980, 1, 1).toordinal()
    pairs = [
        (date.fromordinal(start + rng.randrange(16000)), date.fromordinal(start + rng.randrange(16000)))
        for _ in range(4000)
    ]
    pairs += [
        (date(2024, 1, 30), date(2024, 2, 29)),
        (date(2024, 2, 29), date(2024, 1, 30)),
        (date(2023, 1, 31), date(2023, 2, 28)),
        (date(2024, 2, 29), date(2025, 2, 28)),
    ]
    got = evaluate(spark, dates.tenure_text("a", "b"), pairs, "a date, b date")
    want = [relativedelta(b, a) for a, b in pairs]
    assert got == [f"{d.years} anos {d.months} meses" for d in want]
    assert evaluate(spark, dates.tenure_text("a", "b"), [(None, date(2024, 1, 1))], "a date, b date") == [None]


SECS = [0, 59, 3600, 30000, 93784, None]


def test_duration_texts(spark):
    def got(c):
        return evaluate(spark, c, SECS, "s bigint")

    assert got(durations.hms_text("s")) == [
        "00:00:00", "00:00:59", "01:00:00", "08:20:00", "26:03:04", None,
    ]
    assert got(durations.hours_label("s")) == ["0H", "0H", "1H", "8H:20", "26H:03", None]
    assert got(durations.hours_label("s", pad=True)) == [
        "00H", "00H", "01H", "08H:20", "26H:03", None,
    ]
    assert got(durations.hm00_text("s")) == [
        "00:00:00", "00:00:00", "01:00:00", "08:20:00", "02:03:00", None,
    ]
    assert got(durations.secs_to_clock("s")) == [0, 59, 3600, 30000, 7384, None]
    assert got(durations.zero_if_null("s")) == [0, 59, 3600, 30000, 93784, 0]
    assert got(durations.shift_label("s", F.lit(51600)))[3] == "08H:20 - 14H:20"
    assert evaluate(spark, durations.hms_text("s"), [-5], "s bigint") == ["-00:00:05"]


def test_minutes_and_clock_text(spark):
    assert evaluate(spark, durations.minutes_to_clock("m"), [0, 61, 1439, None], "m int") == [
        "00:00:00.0000000",
        "01:01:00.0000000",
        "23:59:00.0000000",
        None,
    ]
    data = ["08:20:00", "00:00:59.5", "26:03:04", "8:20", "x", "08:61:00", None]
    assert evaluate(spark, durations.clock_to_secs("s"), data, "s string") == [
        30000, 59, 93784, 30000, None, None, None,
    ]


def test_intervals(spark):
    whole = durations.epoch_secs(F.expr("make_dt_interval(d, 2, 3, 4.5)"))
    assert evaluate(spark, whole, [0, 1], "d int") == [7384, 93784]
    wait = durations.secs_between("a", "b")
    a = datetime(2024, 1, 1)
    data = [(a, datetime(2024, 1, 2, 0, 0, 1, 900000)), (a, None), (datetime(2024, 1, 1, 0, 0, 5), a)]
    assert evaluate(spark, wait, data, "a timestamp_ntz, b timestamp_ntz") == [86401, None, -5]


def test_time_of_day(spark):
    data = [datetime(1970, 1, 1, 8, 20, 5), None]
    got = evaluate(spark, durations.secs_of_day("t"), data, "t timestamp_ntz")
    assert got == [30005, None]


def test_code_labels(spark):
    status = codes.code_label("c", codes.CALL_STATUS)
    assert evaluate(spark, status, [200, 303, 999, None], "c int") == [
        "Atendido",
        "Não Atendido",
        None,
        None,
    ]
    assert len(codes.CALL_STATUS) == 22
    kind = codes.code_label("c", codes.QUEUE_TYPES, codes.QUEUE_TYPE_OTHER)
    assert evaluate(spark, kind, [1, 2, 3, 4, None], "c int") == [
        "Receptiva", "Discador", "Mista", "Outras", "Outras",
    ]


def test_hangup_side(spark):
    data = [
        ("2", "ramal", None, 314),
        ("1", "ramal", 5, None),
        ("2", "fila", None, 314),
        ("1", "atendimento fila", None, 314),
        ("3", "fila", None, 314),
        ("4", "ramal", None, 314),
        (None, "fila", 5, None),
        (None, "fila", None, 314),
        ("1", "fila", None, 201),
    ]
    schema = "who string, kind string, survey int, final int"
    side = codes.hangup_side("who", "kind", "survey", "final")
    assert evaluate(spark, side, data, schema) == [
        "Contato", "Operador", "Operador", "Contato", "Supervisor", "Sistema", "Sistema", None, None,
    ]
    state = codes.survey_state("who", "kind", "survey", "final")
    assert evaluate(spark, state, data, schema) == [
        "Cliente Desligou", "Transferido", "Não Transferido", "Cliente Desligou", "Não Transferido",
        "Não Transferido", "Transferido", "Não Transferido", "Não Transferido",
    ]


def test_trial_status(spark):
    d = date
    data = [
        (d(2024, 1, 10), d(2024, 1, 5), d(2024, 1, 10)),
        (d(2024, 1, 11), d(2024, 1, 20), d(2024, 1, 10)),
        (d(2024, 1, 11), None, None),
        (None, d(2024, 5, 31), None),
        (None, d(2024, 6, 1), None),
        (None, None, None),
    ]
    status = codes.trial_status("left", "fim", "ext", d(2024, 6, 1))
    assert evaluate(spark, status, data, "left date, fim date, ext date") == [
        codes.LEFT_IN_TRIAL,
        codes.LEFT_AFTER_TRIAL,
        codes.LEFT_AFTER_TRIAL,
        codes.CONFIRMED,
        codes.IN_TRIAL,
        codes.IN_TRIAL,
    ]


def test_age_bands(spark):
    ages = [-1, 0, 17, 18, 25, 35, 45, 149, 150, None]
    assert evaluate(spark, codes.age_band("a"), ages, "a int") == [
        None, "Menor de 18", "Menor de 18", "18 - 25", "25 - 35", "35 - 45", "45+", "45+", None, None,
    ]


def test_early_exit(spark):
    assert evaluate(spark, codes.early_exit_flag("d"), [90, 91, -3, None], "d int") == [
        True,
        False,
        True,
        False,
    ]


@pytest.mark.parametrize(
    ("score", "zero", "shifted", "first", "later"),
    [
        ("-1", 0, None, "Não opinou", "Não opinou"),
        ("0", 0, "0", None, None),
        ("0", 1, "1", "a", "a"),
        ("2", 0, "2", "b", "b"),
        ("2", 1, "3", "", ""),
        ("x", 0, None, None, None),
        (None, 1, None, None, None),
    ],
)
def test_scores(spark, score, zero, shifted, first, later):
    data, schema = [(score, zero)], "s string, z int"
    assert evaluate(spark, scores.shifted_score("s", "z"), data, schema) == [shifted]
    assert evaluate(spark, scores.score_label("s", F.lit("a:b"), "z"), data, schema) == [first]
    asked = scores.score_label("s", F.lit("a:b"), "z", F.lit("why?"))
    assert evaluate(spark, asked, data, schema) == [later]


def test_score_of_a_question_that_is_not_asked(spark):
    label = scores.score_label("s", F.lit(""), F.lit(1), F.lit(""))
    assert evaluate(spark, label, ["-1", "1"], "s string") == [None, None]


def test_json_text(spark):
    data = ['{"k": 5}', '{"k": null}', "{}", "{bad", None, '{"k": {"a": "x"}}']
    assert evaluate(spark, jsonx.json_text("j", "k"), data, "j string") == [
        "5", None, None, None, None, '{"a":"x"}',
    ]
    assert evaluate(spark, jsonx.json_text("j", "k", "a"), data, "j string")[-1] == "x"


def test_transfer_text(spark):
    data = [
        ('{"transferencia":{"tipo":"A","destino":"B"}}', 201, "A: B"),
        ('{"transferencia":{"tipo":"A","destino":""}}', 201, "A"),
        ('{"transferencia":{"tipo":"A"}}', 201, "A"),
        ('{"transferencia":"x","destino":"y"}', 201, "x: y"),
        ('{"transferencia":"x"}', 201, "x"),
        ('{"transferencia":"{\\"tipo\\":1}"}', 201, '{"tipo":1}'),
        ('{"destino":"y"}', 305, "Destino: y"),
        ("{}", 305, None),
        ('{"destino":"y"}', 203, "-"),
        ('{"destino":"y"}', None, "-"),
        ("{bad", 201, None),
        (None, 201, None),
    ]
    got = evaluate(
        spark, jsonx.transfer_text("e", "s"), [d[:2] for d in data], "e string, s int"
    )
    assert got == [d[2] for d in data]


def test_rating_by_flow(spark):
    rating = jsonx.RATINGS[2]
    data = [
        ("A", '{"REF11": 4}', None, "4"),
        ("B", '{"AVALIACAORECOMENDACAO": "9"}', "AVALIACAO RECOMENDACAO (7", "9"),
        ("B", '{"AVALIACAORECOMENDACAO": null}', "x AVALIACAO RECOMENDACAO (7", "7"),
        ("B", "{bad", "nothing", None),
        ("B", None, None, None),
        ("C", '{"REF11": 4}', None, None),
        (None, '{"REF11": 4}', None, None),
    ]
    value = jsonx.rating_by_flow(rating, "flow", "j", "h", "A", "B")
    got = evaluate(spark, value, [d[:3] for d in data], "flow string, j string, h string")
    assert got == [d[3] for d in data]
