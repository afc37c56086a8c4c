"""Reports over landed tables. All are lazy: a DataFrame goes in, a DataFrame comes out.

Where a report needs the current time, pass ``as_of``; without it, the newest time in
the input is used, so results can be repeated.
"""
