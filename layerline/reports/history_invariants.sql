-- Keys of a history that do not have exactly :currents current versions, or have one that ends before it starts.
-- :history (natural_key, valid_from, valid_to, is_current)
SELECT :name AS dimension, natural_key, count_if(is_current) AS current_versions,
  count_if(NOT valid_from < valid_to) AS reversed_versions
FROM IDENTIFIER(:history)
GROUP BY natural_key
HAVING count_if(is_current) <> :currents OR count_if(NOT valid_from < valid_to) > 0;
