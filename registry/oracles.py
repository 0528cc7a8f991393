"""DuckDB SQL for every registered query, written for checking and independent of the Spark code.

Folders are climbed from each folder up to a root, and department trees come from the closure of all
departments, so that a mistake in walking down a tree would show.
"""

from __future__ import annotations

from registry.fixtures import CONFIG, DAY, END, MONTH, START, source_ctes


def _ids(values: tuple[int, ...]) -> str:
    return ", ".join(str(v) for v in values)


_STAGES = f"""
climb AS (
    SELECT nomenclature_id AS leaf_id, name AS leaf_name, folder AS leaf_parent, root_folder_id AS marker,
           folder AS next_id, [name] AS names, 1 AS steps
    FROM src_nomenclatures WHERE isFolder = 1 AND deleted = 0
    UNION ALL
    SELECT climb.leaf_id, climb.leaf_name, climb.leaf_parent, up.root_folder_id, up.folder,
           list_prepend(up.name, climb.names), climb.steps + 1
    FROM climb, src_nomenclatures up
    WHERE up.nomenclature_id = climb.next_id AND up.isFolder = 1 AND up.deleted = 0
      AND climb.steps < {CONFIG.folder_depth}
),
folders AS (
    SELECT leaf_id, leaf_name, CASE WHEN steps > 1 THEN leaf_parent END AS parent_id, steps, names
    FROM climb WHERE marker = 0
),
catalogue AS (
    SELECT goods.nomenclature_code AS code, goods.name AS good,
           left(folders.names[1], {CONFIG.folder_name_length}) AS f0,
           left(folders.names[2], {CONFIG.folder_name_length}) AS f1,
           left(folders.names[3], {CONFIG.folder_name_length}) AS f2,
           left(folders.names[4], {CONFIG.folder_name_length}) AS f3,
           folders.names AS names
    FROM src_nomenclatures goods
    LEFT JOIN folders
      ON folders.leaf_id = CASE WHEN goods.isFolder IS NULL AND goods.deleted = 0 THEN goods.folder END
),
closure AS (
    SELECT department_id AS top_id, department_id AS id, 0 AS hops FROM src_departments
    UNION ALL
    SELECT closure.top_id, below.department_id, closure.hops + 1
    FROM closure, src_departments below WHERE below.parent_department_id = closure.id
),
reach AS (
    SELECT closure.top_id AS root_id, root.department_name AS root_name, root.parent_department_id AS root_parent,
           member.department_id, member.department_name, member.parent_department_id
    FROM closure
    JOIN src_departments root ON root.department_id = closure.top_id
    JOIN src_departments member ON member.department_id = closure.id
),
units AS (
    (SELECT DISTINCT reach.department_id AS unit_id, reach.department_name AS sector, reach.root_id,
            reach.root_name AS section, up.department_name AS department
     FROM reach JOIN src_departments up ON up.department_id = reach.root_parent
     WHERE reach.root_parent IN ({_ids(CONFIG.section_parent_ids)}))
    UNION ALL
    (SELECT DISTINCT department_id, department_name, root_id, root_name, root_name
     FROM reach WHERE root_id IN ({_ids(CONFIG.section_ids)}))
    UNION ALL
    SELECT department_id, department_name, department_id, department_name, department_name
    FROM src_departments WHERE department_id IN ({_ids(CONFIG.flat_ids)})
),
shipped AS (
    SELECT * FROM src_documents
    WHERE sbis_shipment_date >= DATE '{{start}}' AND sbis_shipment_date < DATE '{{end}}'
      AND shipment = 1 AND deleted = 0 AND invoice_total_sum_calculated > 0
),
recredited AS (
    SELECT shipped.sbis_shipment_date AS day, shipped.document_id AS doc, shipped.number AS num,
           bill.department_id AS unit_id, bill.employee_id AS person_id, 'changed' AS tag
    FROM src_documents bill
    JOIN shipped USING (number)
    JOIN src_view_departments_with_root_folders root ON root.department_id = shipped.department_id
    WHERE root.root_id = {CONFIG.partner_root} AND bill.document_type = '{CONFIG.invoice_type}'
      AND bill.deleted = 0 AND bill.employee_id <> shipped.employee_id
),
own AS (
    SELECT sbis_shipment_date AS day, document_id AS doc, number AS num, department_id AS unit_id,
           employee_id AS person_id, 'not changed' AS tag
    FROM shipped
),
sold AS (SELECT * FROM own UNION ALL SELECT * FROM recredited),
people AS (
    SELECT employee_id AS person_id,
           CASE WHEN last_name IS NULL THEN 'Не известен'
                ELSE first_name || ' ' || substr(last_name, 1, 1) || '.' END AS shown
    FROM src_employees
),
labelled AS (
    SELECT sold.day, sold.doc, sold.num, sold.tag,
           CASE WHEN units.unit_id IS NULL THEN 'Не известен'
                WHEN units.department = '{CONFIG.representatives[0]}' THEN 'Представители'
                ELSE 'Офис' END AS root_department,
           ifnull(units.department, 'Не известен') AS department,
           ifnull(units.section, 'Не известна') AS section,
           ifnull(units.sector, 'Не известен') AS sector,
           CASE WHEN people.person_id IS NULL THEN 'Не известен' ELSE people.shown END AS employe_name
    FROM sold
    LEFT JOIN units USING (unit_id)
    LEFT JOIN people USING (person_id)
),
mart AS (
    SELECT labelled.day AS date, labelled.num AS number, labelled.root_department, labelled.department,
           labelled.section, labelled.sector, labelled.employe_name, catalogue.f0 AS root_folder,
           catalogue.f1 AS folder_1, catalogue.f2 AS folder_2, catalogue.f3 AS folder_3, catalogue.good AS name,
           line.nomenclature_price_total, labelled.tag AS realization
    FROM src_documents_tabular_part line
    JOIN labelled ON labelled.doc = line.document_id
    LEFT JOIN catalogue ON catalogue.code = line.nomenclature_code
),
clean AS (
    SELECT date, number, root_department, department, section, sector, ifnull(employe_name, '') AS employe_name,
           ifnull(root_folder, '') AS root_folder, ifnull(folder_1, '') AS folder_1,
           ifnull(folder_2, '') AS folder_2, ifnull(folder_3, '') AS folder_3, ifnull(name, '') AS name,
           ifnull(nomenclature_price_total, CAST('NaN' AS DOUBLE)) AS nomenclature_price_total, realization
    FROM mart
)
"""


def _sql(final: str, start: object = START, end: object = END) -> str:
    stages = _STAGES.replace("{start}", str(start)).replace("{end}", str(end))
    return f"WITH RECURSIVE {source_ctes()},\n{stages.strip()}\n{final.strip()}"


_SALES_COLUMNS = (
    "day AS sbis_shipment_date, doc AS document_id, num AS number, unit_id AS department_id, "
    "person_id AS employee_id, tag AS realization"
)
_MART = "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM mart"
_CLEAN = "SELECT * FROM clean"
_TWICE = "SELECT * FROM clean UNION ALL SELECT * FROM clean"
_IN_MONTH = f"year(date) * 100 + month(date) = {MONTH}"
_TREE = (
    "SELECT leaf_id AS nomenclature_id, leaf_name AS folder_name, parent_id, steps AS level, "
    "array_to_string(names, ' / ') AS full_path FROM folders"
)


def _subtree(condition: str) -> str:
    return f"SELECT department_id, department_name, parent_department_id, root_id FROM reach WHERE {condition}"


ORACLES: dict[str, str] = {
    "sales_lines": _sql(
        "SELECT own.day AS date, own.num AS number, line.nomenclature_price_total, own.tag AS realization "
        "FROM own JOIN src_documents_tabular_part line ON line.document_id = own.doc"
    ),
    "root_folders": _sql(_TREE + " WHERE steps = 1"),
    "child_folders": _sql(_TREE + " WHERE steps = 2"),
    "folder_tree": _sql(_TREE),
    "folder_listing": _sql(_TREE + " ORDER BY names, leaf_id"),
    "product_hierarchy": _sql(
        "SELECT code AS nomenclature_code, good AS name, f3 AS folder_3, f2 AS folder_2, f1 AS folder_1, "
        "f0 AS root_folder FROM catalogue"
    ),
    "department_subtree_by_parent": _sql(_subtree(f"root_parent IN ({_ids(CONFIG.section_parent_ids)})")),
    "department_subtree_by_id": _sql(_subtree(f"root_id IN ({_ids(CONFIG.section_ids)})")),
    "department_hierarchy": _sql(
        "SELECT unit_id AS department_id, sector, root_id AS original_parent_id, section, department FROM units"
    ),
    "shipped_documents": _sql(
        "SELECT document_id, number, sbis_shipment_date, department_id, employee_id FROM shipped"
    ),
    "outgoing_invoices": _sql(
        "SELECT document_id, number, department_id, employee_id FROM src_documents "
        f"WHERE document_type = '{CONFIG.invoice_type}' AND deleted = 0"
    ),
    "partner_shipments": _sql(
        "SELECT shipped.document_id, shipped.number, shipped.department_id, shipped.employee_id "
        "FROM src_view_departments_with_root_folders root JOIN shipped USING (department_id) "
        f"WHERE root.root_id = {CONFIG.partner_root}"
    ),
    "sales_changed": _sql(f"SELECT {_SALES_COLUMNS} FROM recredited"),
    "sales_not_changed": _sql(f"SELECT {_SALES_COLUMNS} FROM own"),
    "sales": _sql(f"SELECT {_SALES_COLUMNS} FROM sold"),
    "employee_names": _sql("SELECT person_id AS employee_id, shown AS employe_name FROM people"),
    "department_groups": _sql(
        "SELECT src_departments.department_id, "
        "CASE WHEN units.unit_id IS NULL THEN 'Не известен' "
        f"WHEN units.department = '{CONFIG.representatives[0]}' THEN 'Представители' ELSE 'Офис' END "
        "AS root_department, ifnull(units.department, 'Не известен') AS department, "
        "ifnull(units.section, 'Не известна') AS section, ifnull(units.sector, 'Не известен') AS sector "
        "FROM src_departments LEFT JOIN units ON units.unit_id = src_departments.department_id"
    ),
    "credited_sales": _sql(
        "SELECT day AS date, doc AS document_id, num AS number, root_department, department, section, sector, "
        "employe_name, tag AS realization FROM labelled"
    ),
    "sales_mart": _sql(_MART),
    "sales_mart_day": _sql(_MART, DAY, DAY.replace(day=DAY.day + 1)),
    "sales_mart_normalized": _sql(_CLEAN),
    "sales_mart_normalized_null_price": _sql(
        "SELECT * EXCLUDE (date, nomenclature_price_total), date, "
        "CASE WHEN NOT isnan(nomenclature_price_total) THEN nomenclature_price_total END "
        "AS nomenclature_price_total FROM clean"
    ),
    "sales_mart_month": _sql(
        f"SELECT CAST(year(date) * 100 + month(date) AS INT) AS yyyymm, clean.* FROM clean WHERE {_IN_MONTH}"
    ),
    "csv_roundtrip": _sql(_CLEAN),
    "backfill_roundtrip": _sql(_CLEAN),
    "append_roundtrip": _sql(_TWICE),
    "daily_replace_roundtrip": _sql(_CLEAN),
    "daily_roundtrip": _sql(_CLEAN, DAY, DAY.replace(day=DAY.day + 1)),
    "month_partition_roundtrip": _sql(f"SELECT * FROM clean WHERE {_IN_MONTH}"),
    "compact_roundtrip": _sql(_CLEAN),
    "reconcile_roundtrip": _sql(_CLEAN),
    "append_once_roundtrip": _sql(f"SELECT * FROM clean UNION ALL SELECT * FROM clean WHERE date = DATE '{DAY}'"),
    "corrections_roundtrip": _sql(_CLEAN),
    "compact_month_roundtrip": _sql(_TWICE),
    "number_lookup_roundtrip": _sql(
        f"SELECT * FROM ({_TWICE}) twice WHERE (date, number) IN (SELECT (date, max(number)) FROM clean GROUP BY date)"
    ),
}
