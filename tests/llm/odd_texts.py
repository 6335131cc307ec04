"""Invented prose for tests."""

SYLLABLES = {"en": "the ing and ould wh ter ness".split(), "de": "sch ung über keit ein pf ver".split(),
             "fr": "eau tion être ç oui elle dans".split()}


def prose(rnd, lang, words):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(words))
