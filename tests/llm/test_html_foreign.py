"""Text inside svg and math comes out, but not what browsers do not render there."""

from quire.llm import html_layout as hl


def words(page):
    return hl.visible_text(page).split()


def test_svg():
    page = ('<p>a</p><svg viewBox="0 0 1 1"><title>no1</title><desc>no2</desc><defs><text>no3</text></defs><defs/><path d="M0 0"/>'
            '<symbol><text>no4</text></symbol><metadata>no5</metadata><style/><text>Jan</text><text>Feb <tspan>x</tspan></text>'
            '<foreignObject><div>prose <desc>kept</desc></div></foreignObject></svg><p>b <desc>c</desc></p>')
    assert words(page) == ["a", "Jan", "Feb", "x", "prose", "kept", "b", "c"]


def test_math():
    page = ("<p>if <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=no</annotation>"
            "<annotation-xml><ci>no</ci></annotation-xml></semantics></math> then</p><svg/>end")
    assert words(page) == ["if", "x=2", "then", "end"]
