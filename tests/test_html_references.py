from docflow.markup.html import html_markdown


def test_a_reference_without_its_semicolon_is_decoded_as_browsers_do():
    assert html_markdown("<article><h1>a &amp;&amp;&amp</h1><p>b</p></article>") == "# a &&&\n\nb\n"
