"""Steps from meter-days to hours, days and months."""
