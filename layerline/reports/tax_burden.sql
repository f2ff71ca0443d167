-- Taxes over value of live items, by month and family; no ratio where there is no value.
-- :items (issued, family, cancelled, value, taxes)
SELECT year_month(issued) AS ano_mes, family, sum(value) AS valor_produtos, sum(taxes) AS valor_tributos,
  safe_ratio(sum(taxes), sum(value)) AS carga_tributaria_efetiva
FROM IDENTIFIER(:items)
WHERE NOT cancelled
GROUP BY year_month(issued), family
ORDER BY ano_mes, family;
