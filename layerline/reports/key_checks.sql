-- How many keys of each kind are whole, by their check digits.
-- :keys (kind, key)
SELECT kind, count(*) AS n,
  count_if(CASE kind WHEN 'company' THEN is_valid_cnpj(key) ELSE is_valid_access_key(key) END) AS n_valid
FROM IDENTIFIER(:keys)
GROUP BY kind;
