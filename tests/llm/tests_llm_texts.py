"""Made-up sentences in two languages; each number gives another text."""

import random

EN = "the a of and to in that it was for on with as his they at be this have from or had by hot word but what some we can out other were all there when up use your how said an each she which do their time if will way about many then them write would like so these her long make thing see him two has look more day could go come did number sound no most people my over know water than call first who may down side been now find".split()
DE = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei unter wenn schon doch gegen ihre jahr zwischen immer wieder zeit ihm ihn uns etwas große müssen".split()


def _text(words, seed):
    r = random.Random(seed)
    return ". ".join(" ".join(r.choices(words, k=12)).capitalize() for _ in range(8)) + "."


def english(i):
    return _text(EN, i)


def german(i):
    return _text(DE, 1000 + i)
