-- Net value and exact counts of live and cancelled invoices, by month and place.
-- :items (invoice, issued, place, cancelled, value)
WITH per_invoice AS (
  SELECT year_month(issued) AS ano_mes, place, invoice, cancelled,
    sum(CASE WHEN cancelled THEN 0 ELSE value END) AS net
  FROM IDENTIFIER(:items)
  GROUP BY ALL
)
SELECT ano_mes, place, sum(net) AS valor_liquido,
  count_if(NOT cancelled AND invoice IS NOT NULL) AS qtd_notas,
  count_if(cancelled AND invoice IS NOT NULL) AS qtd_notas_canceladas_excluidas
FROM per_invoice
GROUP BY ano_mes, place
ORDER BY ano_mes, place;
