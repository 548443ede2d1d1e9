"""Terms of texts and partial counts over them, by Arrow's own kernels; no term becomes a Python object."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc

#: Rows of partial counts that a task holds before it passes them on.
HELD_ROWS = 200_000


def split_terms(texts: pa.Array, separators: str) -> tuple[pa.Array, pa.DictionaryArray]:
    """(row number, term) of every maximal run of characters outside ``separators`` (a pattern of one or more of them)."""
    lists = pc.split_pattern_regex(texts, separators)
    owner, terms = pc.list_parent_indices(lists), pc.list_flatten(lists)
    solid = pc.greater(pc.binary_length(terms), 0)
    return owner.filter(solid), terms.filter(solid).dictionary_encode()


def merged_counts(partials, keys: list[str], sums: list[str], held_rows: int = HELD_ROWS):
    """Add up tables of ``keys`` and ``sums`` and yield record batches; never more than about twice ``held_rows`` are held."""
    held, rows = [], 0

    def add_up():
        table = pa.concat_tables(held).unify_dictionaries().combine_chunks()
        return table.group_by(keys).aggregate([(s, "sum") for s in sums]).rename_columns(keys + sums)

    for table in partials:
        held.append(table)
        rows += table.num_rows
        if rows > held_rows:
            held = [add_up()]
            rows = held[0].num_rows
            if rows > held_rows // 2:
                yield from _plain(held[0])
                held, rows = [], 0
            pa.default_memory_pool().release_unused()
    if held:
        yield from _plain(add_up())


def _plain(table: pa.Table):
    """Batches without dictionaries, as Spark reads them."""
    for name in table.column_names:
        column = table.column(name)
        if pa.types.is_dictionary(column.type):
            table = table.set_column(table.column_names.index(name), name, column.cast(column.type.value_type))
    yield from table.to_batches(max_chunksize=50_000)
