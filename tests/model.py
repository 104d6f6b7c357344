"""A plain sequential replayer: the model the set-based apply must equal."""


def same(row, image, never):
    if never and any(v is None for v in image):
        return False
    return row == image


def apply_keyed(rows, log, key, never=False):
    """Rows by key; each change is a compare-and-set, refused if its key is taken."""
    table = {key(r): r for r in rows}
    for op, before, after in log:
        if op == "INSERT":
            table.setdefault(key(after), after)
        else:
            hit = table.get(key(before))
            if hit is None or not same(hit, before, never):
                continue
            if op == "DELETE":
                del table[key(before)]
            elif key(after) == key(before) or key(after) not in table:
                del table[key(before)]
                table[key(after)] = after
    return sorted(table.values(), key=repr)


def apply_bag(rows, log, never=False):
    """No key: INSERT always adds, UPDATE and DELETE hit every equal row."""
    table = list(rows)
    for op, before, after in log:
        if op == "INSERT":
            table.append(after)
        elif op == "DELETE":
            table = [r for r in table if not same(r, before, never)]
        else:
            table = [after if same(r, before, never) else r for r in table]
    return sorted(table, key=repr)
