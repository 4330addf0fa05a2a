"""The two key functions, and lookups over a graph, as SQL functions for use in plain SQL text."""

from ..constants import PACKAGE_SCHEMES, ROLE_DEFINITION


def register_sql_functions(spark):
    """Create ``norm_moniker`` and ``storable_symbol`` as temporary SQL functions."""
    schemes = ", ".join(f"'{name}'" for name in PACKAGE_SCHEMES)
    is_package = f"(size(split(symbol, ' ', -1)) >= 5 AND get(split(symbol, ' ', -1), 1) IN ({schemes}))"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION norm_moniker(symbol STRING, label STRING) RETURNS STRING
        DETERMINISTIC RETURN CASE
            WHEN symbol IS NULL OR symbol = '' THEN symbol
            WHEN {is_package} THEN concat_ws(' ',
                get(split(symbol, ' ', -1), 0), get(split(symbol, ' ', -1), 1), '*', '*',
                concat_ws(' ', slice(split(symbol, ' ', -1), 5, size(split(symbol, ' ', -1)))))
            ELSE concat(label, chr(0), symbol) END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION storable_symbol(symbol STRING, label STRING) RETURNS STRING
        DETERMINISTIC RETURN CASE
            WHEN symbol IS NULL OR symbol = '' OR {is_package} THEN symbol
            ELSE concat(label, '/', symbol) END""")


def register_graph_functions(spark, graph, prefix="graph"):
    """Create table functions over a graph: ``definitions_of(name)``, ``references_of(name)`` and ``relationships_of(symbol)``.

    Names are display names, exactly. Called with a column after ``LATERAL`` each becomes an equi join with the graph's
    tables, shown as temporary views with the given prefix; with a literal it is a filter. Roles count as by default.
    """
    views = {
        "names": graph.indexes.names if graph.indexes is not None else graph.named_symbols(),
        "sites": graph.sites(), "definition_sites": graph.definition_sites(), "relationships": graph.relationships(),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(f"{prefix}_{name}")
    places = "file STRING, start_line INT, end_line INT"
    keys = "n.symbol_source = s.symbol_source AND n.symbol_id = s.symbol_id"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION references_of(name STRING)
        RETURNS TABLE (symbol STRING, source STRING, {places}, role INT) RETURN
        SELECT n.symbol, s.source, s.relative_path, s.start_line, s.end_line, s.role
        FROM {prefix}_names n JOIN {prefix}_sites s ON {keys}
        WHERE n.display_name = references_of.name AND s.role <> 0 AND (s.role & {ROLE_DEFINITION}) = 0""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION definitions_of(name STRING)
        RETURNS TABLE (symbol STRING, source STRING, {places}, start_char INT, end_char INT) RETURN
        SELECT n.symbol, s.source, s.relative_path, s.start_line, s.end_line, s.start_char, s.end_char
        FROM {prefix}_names n JOIN {prefix}_definition_sites s ON {keys}
        WHERE n.display_name = definitions_of.name""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION relationships_of(symbol STRING)
        RETURNS TABLE (target STRING, is_reference BOOLEAN, is_implementation BOOLEAN) RETURN
        SELECT r.target, r.is_reference, r.is_implementation FROM {prefix}_relationships r
        WHERE r.symbol = relationships_of.symbol""")
