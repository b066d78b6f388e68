import pytest
from pyspark.sql import functions as F

from grainmill.functions.profiles import LENIENT_ARABIC, PROFILES
from grainmill.operators import quality

IT = "Il treno parte ogni giorno dalla stazione e la gente aspetta con calma il suo turno. "
TR = "Sabah erken saatlerde köyün yolu çok sessiz olur ve çocuklar okula doğru yürür. "
HI = "सुबह के समय गाँव की सड़क पर बहुत शांति होती है और लोग काम पर जाते हैं। "
AR = "في الصباح يخرج الناس من البيوت إلى العمل ثم يعود كل واحد منهم بعد الظهر. "
TH = "ตอนเช้า ผู้คน ใน หมู่บ้าน จะ ไป ทำงาน และ เด็ก ก็ ไป โรงเรียน ที่ อยู่ ใกล้ กับ แม่น้ำ มาก นะ ครับ ทุก วัน. "
PROSE = {"it": IT, "tr": TR, "hi": HI, "ar": AR, "th": TH}


def other(base, k):
    """A sentence of its own for each line, so that lines don't repeat."""
    return f"{base.strip()[:-1]} {k}."


def body(lang, n=3):
    return "\n".join(other(PROSE[lang], k) for k in range(n))


def verdict(spark, text, profile):
    row = quality.annotate(spark.createDataFrame([(1, text)], "doc_id int, text string"), profile).first()
    return row.reject_reason, row.filtered_text


@pytest.mark.parametrize("lang", list(PROFILES))
def test_prose_is_kept(spark, lang):
    reason, text = verdict(spark, body(lang), PROFILES[lang])
    assert reason is None
    assert text == body(lang)


def test_null_and_empty(spark):
    for t in (None, ""):
        assert verdict(spark, t, PROFILES["it"]) == ("too_short_chars", None)


def test_length_boundary(spark):
    t = (IT + IT.replace("treno", "carro"))[:100]
    assert len(t) == 100
    assert verdict(spark, t[:99], PROFILES["it"])[0] == "too_short_chars"
    assert verdict(spark, t, PROFILES["it"])[0] != "too_short_chars"


IT_CASES = {
    "curly_bracket": body("it") + "{",
    "lorem_ipsum": body("it") + " Lorem IPSUM",
    "no_alpha_chars": "1234 " * 40,
    "low_script_ratio": HI * 3,
    "empty": "Javascript attivo qui sotto adesso, per vedere la pagina nel modo in cui è stata pensata da chi la fece.\n",
    "too_few_words": "Sovraccaricatissimamente precipitevolissimevolmente\ninternazionalizzazione particolareggiatamente soddisfacentemente.",
    "line_punct_ratio": "\n".join(other(IT, k)[:-1] + " ancora" for k in range(12)),
    "short_line_ratio": "\n".join(f"La riga {k} è corta." for k in range(12)),
    "bullet_ratio": "\n".join("- " + other(IT, k) for k in range(4)),
    "list_ratio": "\n".join(f"Interminabilissimamente particolareggiato{k}." for k in range(12)),
    "char_dup_ratio": "\n".join([IT.strip()] * 4),
    "excessive_repetition": body("it") + " hahaha",
}


@pytest.mark.parametrize("reason", list(IT_CASES))
def test_each_reason(spark, reason):
    assert verdict(spark, IT_CASES[reason], PROFILES["it"])[0] == reason


def test_turkish_needs_its_letters(spark):
    assert verdict(spark, body("it"), PROFILES["tr"])[0] == "low_turkish_char_ratio"
    assert verdict(spark, "kisa", PROFILES["tr"])[0] == "low_turkish_char_ratio"  # comes before all other rules
    assert verdict(spark, "kısa", PROFILES["tr"])[0] == "too_short_chars"


def test_arabic_script_reason_and_threshold(spark):
    assert verdict(spark, body("it"), PROFILES["ar"])[0] == "low_arabic_ratio"
    mixed = body("ar") + "\n" + "nel mezzo del cammino di nostra vita mi ritrovai per una selva oscura.\n" * 2
    assert verdict(spark, mixed, PROFILES["ar"])[0] != "low_arabic_ratio"


def test_lines_are_dropped_and_citations_removed(spark):
    text = "\n".join([other(IT, 1) + "[12]", "accedi al tuo profilo per vedere il resto della pagina", "x" * 101 + " è una parola", "Menu", "Fine.", other(IT, 2), other(IT, 3) + "[citation needed]", "javaScript richiesto in questa pagina"])
    reason, out = verdict(spark, text, PROFILES["it"])
    assert reason is None
    assert out == "\n".join([other(IT, 1), "Fine.", other(IT, 2), other(IT, 3)])
    df = spark.createDataFrame([(text,)], "text string")
    drops = {r.reason: r.lines for r in quality.line_drop_histogram(df, PROFILES["it"]).collect()}
    assert drops == {"line_policy": 1, "line_long_word": 1, "line_too_few_words": 1, "line_javascript": 1, "kept": 4}


def test_word_of_exactly_the_limit_stays(spark):
    keep = body("it") + "\n" + "x" * 100 + " è lunga."
    assert verdict(spark, keep, PROFILES["it"].__class__(**{**PROFILES["it"].__dict__, "filter_repetition": False}))[1].endswith("è lunga.")


def test_short_line_boundary(spark):
    long = [other(IT, k) for k in range(3)]
    at = "Questa riga ha trenta segni ab."[:29] + "."
    assert len(at) == 30
    p = PROFILES["it"].__class__(**{**PROFILES["it"].__dict__, "short_line_thr": 0.2})
    assert verdict(spark, "\n".join([*long, at]), p)[0] == "short_line_ratio"
    assert verdict(spark, "\n".join([*long, at[:-1] + "x."]), p)[0] is None


def test_zero_punctuation_is_excused_where_the_profile_says_so(spark):
    text = "\n".join(other(HI, k)[:-1] + " क" for k in range(3)).replace("।", "")
    assert verdict(spark, text, PROFILES["hi"])[0] is None
    text = "\n".join(other(IT, k)[:-1] + " ancora" for k in range(3))
    assert verdict(spark, text, PROFILES["it"])[0] == "line_punct_ratio"


def test_lenient_profile(spark):
    short = AR.strip()[:70]
    assert verdict(spark, short, PROFILES["ar"])[0] == "too_short_chars"
    assert verdict(spark, short, LENIENT_ARABIC)[0] is None


def test_optional_rules(spark):
    p = PROFILES["it"].with_optional_rules()
    varied = "Il treno parte ogni giorno dalla stazione.\nLa gente aspetta con calma il suo turno.\nNel frattempo qualcuno legge e altri parlano piano."
    assert verdict(spark, varied, p)[0] is None
    phrase = "la casa sul lago è molto grande "
    assert verdict(spark, "\n".join(f"{phrase * 3}numero {k}." for k in range(3)), p)[0] == "top_5_gram_frac"
    assert PROFILES["it"].optional is False


def test_by_language_and_apply(spark):
    rows = [(1, "it-IT", body("it")), (2, "tha_Thai", body("th")), (3, None, body("it")), (4, "hi", body("it"))]
    df = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    got = {r.doc_id: r.reject_reason for r in quality.annotate_by_language(df).collect()}
    assert got == {1: None, 2: None, 3: "no_profile", 4: "low_script_ratio"}
    kept = quality.apply(df.where("doc_id <= 2").withColumn("extra", F.lit("x")), PROFILES["it"]).collect()
    assert [(r.doc_id, r.extra) for r in kept] == [(1, "x")]


def test_filtering_does_not_copy_expressions(spark):
    df = spark.createDataFrame([(1, body("it"))], "doc_id int, text string")
    plan = quality.annotate(df, PROFILES["it"]).where("reject_reason is null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gdpr") == 1


def test_filtered_text_is_stable(spark):
    """The line rules drop nothing more on a second run."""
    once = verdict(spark, body("it") + "\nMenu", PROFILES["it"])[1]
    assert verdict(spark, once, PROFILES["it"])[1] == once


def test_own_rules_come_first(spark):
    from dataclasses import replace

    own = replace(PROFILES["it"], leading=((lambda s: F.contains(s, F.lit("vietato")), "own_rule"), (lambda s: F.length(s) > 10**6, "too_long")))
    df = spark.createDataFrame([(1, "vietato"), (2, "corto"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.reject_reason for r in quality.annotate(df, own).collect()}
    assert got == {1: "own_rule", 2: "too_short_chars", 3: "too_short_chars"}
