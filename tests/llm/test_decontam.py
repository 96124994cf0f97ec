import random

from shelfspark.llm import decontam
from tests.llm.helpers import EDGES, documents, empty

ITEMS = [
    (1, "A farmer named Alice sells 12 baskets of ripe apples at the market. Each basket weighs 3 kg, so how many kg did Alice carry to market that day?"),
    (2, "The quick brown fox jumps over the lazy dog while a sleepy cat watches quietly from the warm kitchen window sill."),
    (3, "too short"),
    (4, None),
]
COPY = "Intro words come first here. " + ITEMS[0][1] + " And more follows after it."
PARAMETERS = "Something else before. " + ITEMS[0][1].replace("Alice", "Boris").replace("12", "40").replace("3 kg", "7 lb").replace("many kg", "many lb")
MIXED = ITEMS[0][1].replace("named Alice", "named Boris").replace("did Alice", "did Carla") + " Nothing else."
HALF = "Start of text. " + " ".join(ITEMS[1][1].split()[:9]) + " and then something completely different happens to them all."
ROWS = EDGES + [(50, COPY), (51, PARAMETERS), (52, MIXED), (53, ITEMS[1][1].upper()), (54, HALF), (55, "A clean text about nothing in particular, with 12 apples and 3 kg of flour."), (56, COPY + " " + COPY)]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_copies_and_new_parameters_are_found(spark):
    out = {(r.doc_id, r.item_id): r for r in decontam.contaminated(documents(spark, ROWS), items(spark)).collect()}
    assert set(out) == {(50, 1), (51, 1), (53, 2), (56, 1)}
    assert out[(50, 1)].coverage == 1.0 and not out[(50, 1)].reparameterised
    assert out[(51, 1)].reparameterised and out[(51, 1)].n_slots >= 3
    words = decontam.Canonical()(COPY)[1]
    first, last = out[(50, 1)].first_word, out[(50, 1)].last_word
    assert 0 < first < last < len(words) and last - first + 1 == len(decontam.Canonical()(ITEMS[0][1])[1])


def test_small_blocks_give_the_same(spark):
    docs = documents(spark, ROWS)
    a, b = (sorted(tuple(r) for r in decontam.contaminated(docs, items(spark), block_windows=n).collect()) for n in (100_000, 5))
    assert a == b


def test_filter_keeps_clean_rows(spark):
    docs = documents(spark, ROWS)
    kept = decontam.without_contaminated(docs, items(spark))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((d or -1) for d, _ in ROWS if d not in (50, 51, 53, 56))


def test_empty_tables(spark):
    none = items(spark).where("item_id < 0")
    assert decontam.contaminated(documents(spark, ROWS), none).count() == 0
    assert decontam.contaminated(empty(spark), items(spark)).count() == 0


def test_query_finds_planted_items(spark):
    from shelfspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    planted = {(d.doc_id, b.item_id) for d in rows for b in bench if b.text in d.text}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op9_decontamination"](spark, sf).collect()}
    assert planted <= got and len(got - planted) <= 1


def flagged(spark, items, rows):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.contaminated(documents(spark, rows), bench).collect()}


def test_repeated_windows_and_equal_values(spark):
    twice = "Tom has 3 red apples in a bag and then walks over to the old market where he meets a friend, so later Tom has 5 red apples in a bag again."
    pens = "The teacher ordered 12 pens and 12 books for the children who came to the library after school on that rainy afternoon."
    apart = "The baker sold 14 loaves before noon and 25 loaves after lunch while the rain kept falling on the empty street."
    rows = [(1, "Before it. " + twice), (2, twice.replace("3 red", "8 red").replace("5 red", "9 red")), (3, pens.replace("12 pens", "30 pens").replace("12 books", "45 books")), (4, apart.replace("14", "7").replace("25", "7"))]
    out = flagged(spark, [(1, twice), (2, pens), (3, apart)], rows)
    assert set(out) == {(1, 1), (2, 1), (3, 2), (4, 3)} and all(r.coverage == 1.0 for r in out.values())
    assert [out[k].reparameterised for k in sorted(out)] == [False, True, True, True]


def test_a_copy_beside_another_with_mixed_names(spark):
    out = flagged(spark, ITEMS, [(1, MIXED + " " + COPY), (2, ITEMS[0][1].replace("baskets", "big baskets")), (3, MIXED + " " + MIXED)])
    assert set(out) == {(1, 1), (2, 1)} and out[(1, 1)].coverage == 1.0 and out[(2, 1)].coverage == 1.0


def test_renamed_sentence_starts_and_changed_words(spark):
    sold = "Natalia sold some clips to a friend in the spring. Natalia then bought fresh paint for the old fence. Natalia kept the rest."
    marbles = "Ben has 14 marbles. Ben gives 5 to a friend. Ben finds 3 more under the bed."
    short = "Water boils sooner on high mountains than beside the sea because air is thin."
    shorter = "The tallest tower stands near a frozen lake."
    rows = [(1, sold.replace("Natalia", "Ingrid")), (2, marbles.replace("Ben", "Olga").replace("14", "20").replace("5", "6").replace("3", "9")), (3, "Some words. " + short.replace("than", "or")), (4, shorter.replace("stands", "rises"))]
    rows += [(5, "Olga has 14 cats. Ben hates a friend. Max finds many toys under a tree."), (6, "The tallest tower was torn down."), (7, "Nobody stands near a frozen river.")]
    assert set(flagged(spark, [(1, sold), (2, marbles), (3, short), (4, shorter)], rows)) == {(1, 1), (2, 2), (3, 3), (4, 4)}


def test_items_without_a_usable_window(spark):
    items = [(1, "What is 345 * 12?"), (2, "Pride and Prejudice"), (3, "12 18 24 30 36 42, and 48"), (4, "水在高山上比在海边更快沸腾，因为空气稀薄。"), (5, "首都"), (6, "Add 12 kg flour, 3 l milk, then 5 eggs"), (7, "!!!"), (8, "")]
    rows = [(1, "Here: what is 345 * 12? Nobody knows."), (2, "She read Pride and Prejudice twice."), (3, "Go on with 12 18 24 30 36 42, and 48 then"), (4, "他说水在高山上比在海边更快沸腾，因为空气稀薄。是的"), (5, "北京是首都"), (6, "Now add 20 kg flour, 7 l milk, then 9 eggs at once")]
    rows += [(11, "What is 346 * 12?"), (12, "Pride or Prejudice"), (13, "12 18 24 30 36 42, and 49"), (14, "水在"), (15, "首 x 都"), *EDGES]
    out = flagged(spark, items, [(d if d is None or d < 10 and (d, t) not in EDGES else d + 100, t) for d, t in rows])
    assert set(out) == {(d, d) for d in range(1, 7)}
    assert out[(6, 6)].reparameterised and not out[(1, 1)].reparameterised and out[(2, 2)].first_word == 2


def test_filter_tells_rows_by_id_and_text(spark):
    rows = [(None, COPY), (None, "a clean text without an id"), (60, COPY), (60, "a clean text of the same id")]
    kept = decontam.without_contaminated(documents(spark, rows), items(spark)).collect()
    assert {(r.doc_id, r.text) for r in kept} == {rows[1], rows[3]}


class Unbounded(decontam.Items):
    """Judges every item that shares a window with the document, without the count of words alike."""

    def worthwhile(self, doc, item, place, at, least):
        for i in sorted(set(item.tolist())):
            yield i, place[item == i], at[item == i]


def test_count_of_words_alike_loses_no_item():
    rng = random.Random(5)
    vocabulary = "ab cd ef gh ij kl Bob Eve Tim 3 7 12 km red the of".split()

    def words(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    found = 0
    for _ in range(60):
        prompt = words(rng.randint(5, 12))
        rows = [(k, (prompt + " " if rng.random() < 0.6 else "") + words(rng.randint(1, 30))) for k in range(8)]
        bounded, unbounded = decontam.Items(rows, 5, 3), Unbounded(rows, 5, 3)
        for _ in range(5):
            text = " ".join(words(rng.randint(0, 15)) + " " + rng.choice([prompt, *(t for _, t in rows)]) for _ in range(rng.randint(1, 5))).split()
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            doc = decontam.Canonical()(" ".join(text))
            ours = sorted(bounded.found(doc, 0.6))
            assert ours == sorted(unbounded.found(doc, 0.6))
            found += len(ours)
    assert found > 300


def test_common_prompt_costs_no_search_for_each_item(monkeypatch):
    rng = random.Random(6)
    prompt = "answer the following question with care and give only one final number please"
    words = [a + b for a in "bcdfghjklm" for b in ("ato", "eli", "ura", "ony", "iske")]
    rows = [(k, prompt + " " + " ".join(rng.choice(words) for _ in range(30))) for k in range(1000)]
    text = " ".join([*rng.choices(words, k=100), prompt, *rng.choices(words, k=100), rows[77][1], *rng.choices(words, k=100)])
    searched, chains = [], decontam.chains
    monkeypatch.setattr(decontam, "chains", lambda *args: searched.append(1) or chains(*args))
    assert [f[0] for f in decontam.Items(rows, 5, 3).found(decontam.Canonical()(text), 0.6)] == [77]
    assert len(searched) <= 5
