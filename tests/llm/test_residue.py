import pytest

from movelane.llm import residue

REAL = "The firm has hired a partner in its tax group. Clients had asked for a senior name since the spring. "
RESIDUE = [
    REAL + "{{firm}} said so.", REAL + "Dear ${first.name},", REAL + "in <%= office.city %>", REAL + "{% block body %}", REAL + "%FIRM_NAME%", REAL + "[[practice_area]]", REAL + "<<PARTNER_NAME>>", REAL + "__JOB_TITLE__",
    REAL + "@@DATE@@", REAL + "*|FNAME|*", REAL + "[Firm Name]", REAL + "[INSERT QUOTE HERE]", REAL + "[TBC: number of partners]", REAL + "{0}", REAL + "{firstName}", REAL + "{person_name}", REAL + "[object Object] joins.", REAL + "undefined joins the firm.",
    REAL + "&lt;name&gt;", REAL + "said Maria %s of", REAL + "\nLorem ipsum dolor sit amet, consectetur adipiscing elit.", REAL + "\nText to follow", "Copy to come", "TEXT TO COME. 300 WORDS ON THE HIRE.", "Ici votre texte. À compléter par la rédaction.",
    "Write your article here / Caption goes here", "xxxxx xxxx xxxxxxx xx", "404\nPage not found\nGo back | Reload", "Please enable JavaScript to view this page.", "A headline about a hire\n\nYou need to enable JavaScript to run this app.",
    "502 Bad Gateway\nproxy/7", "Traceback (most recent call last):\nFile \"app/views.py\", line 9, in article\nKeyError: 'headline'", "页面不存在或已被删除。", "Loading...\n\nIf nothing happens, check that scripting is allowed for this domain.",
]
LONG = "a very long default " * 12
# Beyond the lengths that grammars once stopped at, common words beside placeholders, and failures in words of their own.
RESIDUE += [
    REAL + '{{ a.b | default("' + LONG + '") | upper }}', REAL + "{% if a %2 " + LONG + "%}", REAL + "<%= " + LONG + "%>", REAL + "[[" + LONG + "]]", REAL + "[INSERT " + LONG + "]", REAL + "%%" + "A" * 90 + "%%",
    "Dear {{ customer.name }}, we write to thank you.", REAL + "Please write to {{email}}, for example today.", REAL + "Dear [client name],", "Sorry, this content isn't available right now. The server took too long to respond. Refresh the page or come back later.",
    "Your session could not be verified. Clear your cookies and sign in again.", "The website is overloaded. Please wait a moment and reload.", "A headline that is long " * 15 + "\nPage not found\nGo back | Reload",
]
FINE = [
    None, "", "   \n ", REAL, REAL + 'The court held in [2023] UKSC 12 that "[the] partner" owed no duty [sic].', REAL + "The set {a, b} in the formula was misprinted.", REAL + "<|endoftext|> <s></s><unk> is text.",
    REAL + "The variable was undefined in the agreement.", REAL + "Counsel said the designer had left lorem ipsum in the prospectus.", REAL + "Readers who met a 404 page on the old site can now find the archive.", '"Access denied" was the headline when the regulator lost its appeal. ' + REAL,
    "An internal server error delayed the filing by 12 minutes, and the registrar extended time. " + REAL, REAL + "The dispute turns on whether pages would work without JavaScript.", "A tutorial:\n```\nHello {{name}}\n```\n" + REAL, "In this syntax a placeholder such as {{name}} is replaced. " + REAL, "More to follow. " + REAL,
    "x" * 200_000, REAL + "The timetable remains largely undefined.", REAL + 'Designers set "Lorem ipsum dolor sit amet, consectetur adipiscing elit" as a specimen of type.', REAL + 'Type "{{ name }}" where the name should go.',
    "Merge fields and placeholders explained. For example, {{ name }} is filled when the letter prints. " + REAL, "He said the server room was moved after a problem with the network; partners will return to the site later this year, and the firm expects no failures.",
]


@pytest.mark.parametrize("texts, wanted", [(RESIDUE, True), (FINE, False)])
def test_cases(spark, texts, wanted):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as placeholder", "2 as filler", "3 as notice")
    found = {r.doc_id for r in residue.residue(frame).collect()}
    wrong = [texts[i] for i in range(len(texts)) if (i in found) != wanted]
    assert not wrong


def test_repeats_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "Copy to come"), (1, "Copy to come"), (None, "Copy to come")], "doc_id long, text string")
    assert sorted((r.doc_id or 0) for r in residue.residue(frame).collect()) == [0, 1, 1]
    assert residue.residue(frame.limit(0)).count() == 0
