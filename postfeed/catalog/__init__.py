"""The registered queries, and for each the SQL another engine checks it with."""
