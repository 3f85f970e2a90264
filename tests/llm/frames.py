"""Small frames with every awkward case."""

LONG = " ".join(f"word{i % 977} the of and" for i in range(20_000))
PROSE = ("The river runs past the old mill and the people of the town come there in the evening to talk and to rest. "
         "They say that the water was once so clear that one could see the stones on the ground of it.\n"
         "Nobody knows whether this is true, but all of them like to tell it to those who are new here.")
GERMAN = ("Der Fluss fließt an der alten Mühle vorbei und die Leute aus der Stadt kommen am Abend dorthin, um zu reden und zu "
          "ruhen. Sie sagen, dass das Wasser einst so klar war, dass man die Steine auf dem Grund sehen konnte.\n"
          "Niemand weiß, ob das wahr ist, aber alle erzählen es gern denen, die neu hier sind.")
TEXTS = [
    (0, PROSE, "en", "a"), (1, GERMAN, "de", "b"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, "en", "a"),
    (4, "", None, None), (5, "  \n\t ", "en", None), (6, LONG, "en", "c"), (7, "one two", "en", "a"), (None, PROSE + " more", "en", "b"),
    (None, GERMAN, "de", None), (8, PROSE.upper(), "en", "a"), (9, "12345 %%% ###", "de", "b"), (10, "漢字 🙂  x\r\n\r\n y ", "en", "b"),
    (11, "a b c " * 50, None, "a"), (12, "<|endoftext|> it's  <|endoftext|>\n", "en", "a"),
]
EXTRA = "digest string, component long, component_id string, score int, kept string, n_tokens string, code int, n string, key string, _c int"
EXTRA += ", _key string, _row int, _block long, _passes int, _upto long, _whole string, _row_id long, _row_digest int, _row_without int, _all int"
OWN = {"_key": "own", "_row": 5, "_block": 6, "_passes": 7, "_upto": 8, "_whole": "mine", "_row_id": 9, "_row_digest": 10, "_all": 12, "_c": 4}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def documents(spark, rows=TEXTS):
    more = ("x", 1, "y", 2, None, "z", 3, "w", "v", 4, "own", 5, 6, 7, 8, "mine", 9, 10, 11, 12)
    return spark.createDataFrame([(*r, len(r[1] or ""), *more) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
