"""Synthetic listing pages in the two layouts; addresses from documentation ranges."""


def wide_row(ip, port, label="高匿", http="HTTPS", address="\n <a href='/x'>某地</a>\n ", speed="0.3秒"):
    bar = f'<div title="{speed}" class="meter"><div class="fill" style="width:9%"></div></div>'
    cells = ["<img src=f.png>", ip, port, address, label, http, bar, bar, "41天", "24-03-05 07:10"]
    return "<tr class=''>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def narrow_row(ip, port, label="高匿名", http="http", address=" 某地 ", speed="1秒"):
    cells = [ip, port, label, http, address, speed, "2024/03/05 07:10:00"]
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def wide_page(*rows, head="<tr><th>国家</th><th>IP</th></tr>"):
    return f"<html><body><br><table id='ip_list'><tbody>{head}{''.join(rows)}</tbody></table></body></html>"


def narrow_page(*rows, head="<tr><th>IP</th></tr>"):
    return f"<html><div id=list><table><tbody>{head}{''.join(rows)}</tbody></table></div></html>"


def page(site, number, html, kind="1", kinddesc="d", status=200):
    return (site, kind, kinddesc, f"{site}.example", f"http://{site}.example/{number}", number, status, html)
