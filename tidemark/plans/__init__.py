"""The registered queries: how the operators answer questions on the driver's tables, and the SQL they are compared with."""
