"""Training texts of the residue models: wordings of web servers, publishing systems and templates, put together from rules.

Written from general knowledge of such systems; no sentence is taken from the test tables, which a test checks. What the
writer knew of these tables all the same is told in the README. A template's {slots} are filled in every seeded draw anew.
"""

from __future__ import annotations

import re
import string

import numpy as np

# The slots of the templates.
SLOTS = {
    "thing": "page|document|article|file|resource|item|record|entry|content|website|site|link|address|image|abstract|full text|section|chapter|report|view|listing|screen|profile|leaflet",
    "cannot": "could not be found|cannot be displayed|cannot be opened|was removed|has been deleted|has moved|failed to load|is missing|is gone|is temporarily unavailable|is currently unavailable|is not available right now|does not exist|did not load|is restricted|could not be retrieved|may have been renamed|is blocked|expired|can't be reached",
    "script": "JavaScript|Javascript|scripts|scripting|cookies|JavaScript and cookies|active scripting|browser cookies|session cookies|third-party cookies|client-side scripts",
    "off": "disabled|turned off|switched off|blocked|not enabled|not supported|deactivated|missing|unavailable|not accepted",
    "on": "enable|turn on|switch on|allow|activate|accept|permit|unblock",
    "code": "Bad Request|Unauthorized|Payment Required|Forbidden|Not Found|Method Not Allowed|Not Acceptable|Request Timeout|Conflict|Gone|Length Required|Precondition Failed|Payload Too Large|Unsupported Media Type|Too Many Requests|Internal Server Error|Not Implemented|Bad Gateway|Service Unavailable|Gateway Timeout|Service Temporarily Unavailable|Moved Permanently|Proxy Error|Server Error",
    "who": "the administrator|your administrator|customer support|the webmaster|the help desk|our support team|the site owner|your librarian|your network provider|us",
    "soon": "later|again later|again in a few minutes|again in a moment|again shortly|again after some time|once more|again tomorrow|another time",
    "do": "refresh the page|reload this page|go back|return to the homepage|check the spelling of the address|check your connection|clear your cache|update your browser|use another browser|contact support|log in again|sign in|use the search box|follow this link|wait a few seconds|close this window|restart your browser",
    "robot": "a robot|a bot|automated traffic|a program|an automated script|a crawler",
    "n": "7|12|403|404|500|502|503|504|30|60|1024|8080|20240117",
    "ding": "Seite|Website|Datei|Inhalt|Artikel|Eintrag|Dokument|Adresse|Ressource|Text|Ansicht",
    "cosa": "página|sitio|archivo|contenido|artículo|documento|recurso|dirección|ficha|texto",
    "chose": "page|site|fichier|contenu|article|document|ressource|adresse|fiche|texte",
    "name": "name|first_name|last_name|patient|patient_name|drug|product|title|date|dose|dosage|email|address|city|country|id|number|phone|url|author|journal|year|value|amount|company|summary|text|body|heading|section|source|reference|description|user|account|total|count|label|batch|doctor|clinic|site|month|age|weight|unit|contact|version|code|key|term|item|image|price",
    "filter": "upper|lower|trim|default|safe|escape|capitalize|date|join|first",
    "object": "user|patient|page|record|order|item|data|doc|article|label|site|product|row|props|ctx|config|request|form|study|entry",
    "fill": "name|your name|title|date|drug name|text|address|company|value|number|reference|details|description|summary|contact|dose|product|country|author|email|heading|location|result|amount|age|source",
    "sample": "sample|dummy|example|placeholder|filler|demo|test|default|temporary|draft",
    "matter": "text|content|copy|paragraph|sentence|body text|entry|description|caption|heading|data",
    "here": "here|in this box|in this field|below|in this space|in this area|on this line",
    "unit": "mg|ml|tablets|patients|days|weeks|hours|percent|times|years|units|doses|cases|kg",
}

#: Messages of servers and sites.
NOTICE = """
{n} {code}
Error {n}: {code}
HTTP {n} - {code}
HTTP Status {n} – {code}
HTTP/1.1 {n} {code}
Status: {n} ({code})
{code}
{code}. Please try {soon}.
The {thing} you requested {cannot}.
The requested {thing} {cannot}.
The {thing} {cannot}. Please {do} or {do}.
Sorry, this {thing} {cannot}.
Sorry! We couldn't find the {thing} you wanted.
We're sorry, but the {thing} {cannot}.
We cannot find the {thing} that you are trying to open.
This {thing} {cannot}. You may want to {do}.
That {thing} {cannot}.
No {thing} was found at this address. Please {do}.
Oh no! The {thing} {cannot}.
Oops, an error occurred. Please {do}.
Whoops, looks like something broke. Try {soon}.
Something went wrong on our end. We are working on it. Please try {soon}.
An error occurred while processing your request. Please try {soon}.
An unexpected error happened. Please contact {who}.
The server encountered an error and could not complete your request.
The server is busy. Please try {soon}.
The server took too long to respond. {do}.
The server returned an invalid or incomplete response.
If the problem persists, contact {who} and quote the code {n}.
If you believe this is an error, please contact {who}.
If you are the owner of this site, check the error log. Request ID: {n}
Error reference: {n}. Incident number: {n}. Session ID: {n}. Support ID: {n}
Your IP address has been blocked. Contact {who}. Ray ID: {n}
Your access to this {thing} has been limited by the site owner.
You do not have permission to view this {thing}.
You don't have access to this {thing}. Please sign in or contact {who}.
You are not authorized to access this {thing}. Log in with your account.
Access denied. You need a subscription to read this {thing}.
Access forbidden. Sign in to continue.
Please log in to view the {thing}. Forgot your password? Create an account.
Login required. Please enter your username and password.
Your session timed out. Please log in again.
Your session is no longer valid. Please {do}.
Your request was blocked because it looked like {robot}.
Our systems have detected unusual traffic from your network. Are you {robot}? Solve the captcha.
Please confirm that you are not {robot} by ticking the box.
Please verify you are a human to go on. Complete the security check.
Please wait while we check your browser. You will be redirected automatically in {n} seconds.
One moment please, your request is being verified.
Just a moment... Loading. Please wait. Redirecting you to the {thing}.
The viewer is loading. If the {thing} does not appear, {do}.
You have reached your request limit. Slow down and try {soon}.
Rate limit exceeded. Retry after {n} seconds.
The site is undergoing scheduled maintenance. We will be back online soon.
We are performing maintenance on this site. Sorry for the inconvenience. Check back {soon}.
Down for maintenance. Back at {n}:{n}. Thank you for your patience.
Temporarily offline for an upgrade. The {thing} returns soon.
This {thing} is not available in your country or region for legal reasons.
This {thing} is only open to subscribers and members. Buy access for {n}.
Unable to connect to the database. Error establishing a database connection.
Warning: mysql_connect(): connection refused in /var/www/html/index.php on line {n}
Fatal error: Uncaught exception in /srv/app/view.php:{n} Stack trace: #{n} main thrown
Traceback: File "/app/views.py", line {n}, in get_{name} raise KeyError("{name}")
{name}Error: could not render {object}.{name}, line {n}
TypeError: Cannot read properties of null (reading '{name}') at {object}.js:{n}
java.io.IOException: connection reset at org.server.{object}.load({object}.java:{n}) Caused by: timeout
NullReferenceException: Object reference not set to an instance of an object.
Unhandled exception. Segmentation fault. Core dumped. Out of memory.
{{"error": {{"code": {n}, "message": "{code}", "status": "FAILED"}}}}
{{"ok": false, "reason": "{thing} {cannot}", "{name}": null, "request_id": "{n}"}}
{{"message": "{code}", "documentation_url": "", "timestamp": {n}, "detail": "{thing} {cannot}"}}
<html><head><title>{n} {code}</title></head><body><center><h1>{n} {code}</h1></center><hr>nginx</body></html>
<html><body><h2>{code}</h2><p>The {thing} {cannot}.</p></body></html>
<div class="error"><p>The {thing} {cannot}.</p></div>
<?xml version="1.0" encoding="UTF-8"?><Error><Code>{name}</Code><Message>The {thing} {cannot}.</Message><RequestId>{n}</RequestId></Error>
upstream request timed out. no healthy upstream. connection reset by peer, attempts: {n}
DNS lookup failed. Host unreachable. Connection closed by remote host. Network is down.
Please {on} {script} in your browser to view this {thing}.
Please {on} {script} to proceed.
You must {on} {script} to see the {thing}.
To use this {thing} you have to {on} {script} and reload.
This {thing} requires {script}. Please {on} them and {do}.
This {thing} needs {script} to work properly.
This application will not function without {script}.
It appears that {script} is {off} in your browser. To continue, {on} it and {do}.
{script} is {off}. Please {on} it to read the {thing}.
{script} are {off}. {on} them in the settings, then {do}.
Your browser has {script} {off}. Some parts of this {thing} will not be shown.
Your browser is out of date and is not supported. Please {do}.
We use cookies to give you the best experience. Accept all. Reject. Manage preferences.
By continuing to use this {thing} you accept our use of cookies. Privacy policy.
<noscript>Please {on} {script} to show this {thing}.</noscript>
Home About Contact Search Login Register Help Menu Skip to navigation
Back to top. Share this {thing}. Print. Download. Next. Previous. Click here to {do}.
Leider konnte die {ding} nicht geladen werden. Bitte versuchen Sie es später erneut.
Fehler {n}: Die gewünschte {ding} existiert nicht mehr. Zurück zur Startseite.
Diese {ding} ist zurzeit nicht erreichbar. Wir arbeiten an der Behebung.
Sie haben keine Berechtigung, diese {ding} zu öffnen. Bitte loggen Sie sich ein.
Ihre Anmeldung ist abgelaufen. Melden Sie sich erneut an, um fortzufahren.
JavaScript ist in Ihrem Browser deaktiviert. Bitte schalten Sie es ein, damit der {ding} erscheint.
Bitte erlauben Sie Cookies und Skripte in den Einstellungen und laden Sie die {ding} neu.
Ein unerwarteter Fehler ist aufgetreten. Wenden Sie sich an den Administrator. Serverfehler {n}.
Der Server ist wegen Wartungsarbeiten vorübergehend nicht verfügbar.
Lo siento, no se pudo cargar la {cosa}. Inténtelo de nuevo más tarde.
Error {n}: la {cosa} que busca no existe o fue eliminada. Vuelva al inicio.
El {cosa} no está disponible en este momento. Estamos trabajando para solucionarlo.
No tiene permiso para acceder a esta {cosa}. Inicie sesión para continuar.
Su sesión ha caducado. Vuelva a iniciar sesión.
Su navegador no tiene JavaScript habilitado. Habilite JavaScript y las cookies para ver la {cosa}.
Debe permitir las cookies y los scripts para usar este {cosa}.
Se produjo un error inesperado en el servidor. Póngase en contacto con el administrador.
Sitio en mantenimiento. Disculpe las molestias.
Désolé, la {chose} n'a pas pu être chargée. Veuillez réessayer plus tard.
Erreur {n} : la {chose} que vous cherchez n'existe pas ou a été supprimée. Retour à la page d'accueil.
Cette {chose} est momentanément indisponible. Merci de patienter.
Vous n'avez pas l'autorisation d'accéder à cette {chose}. Connectez-vous pour continuer.
Votre session a expiré. Veuillez vous reconnecter.
JavaScript est désactivé dans votre navigateur. Merci de l'activer pour afficher cette {chose}.
Vous devez autoriser les cookies et les scripts pour utiliser ce {chose}.
Une erreur inattendue s'est produite sur le serveur. Contactez l'administrateur.
Site en maintenance. Veuillez nous excuser pour la gêne occasionnée.
"""

#: Text that only fills space, apart from pseudo-Latin and pressed keys, which rules give.
FILLER = """
This is {sample} {matter}.
This is just {sample} {matter} and will be replaced.
This {sample} {matter} should be replaced with the real {matter}.
Replace this {matter} with your own {matter}.
Replace this {sample} {matter} before publishing.
Put your {matter} {here}.
Your {matter} goes {here}.
Type some {matter} {here}.
Add a {matter} {here}.
Write the {matter} {here}.
Edit this {matter} to add your {fill}.
Enter the {fill} {here}.
{sample} {matter} {here}.
{sample} {matter} {sample} {matter} {sample} {matter}
{matter} to follow. {matter} coming soon. More {matter} to come.
This {thing} is intentionally left blank.
This {thing} was left empty on purpose. Do not use. Ignore this {matter}.
A {sample} {thing}, please ignore.
Only a {sample}. Please delete this {thing}.
Under construction. Coming soon.
The quick brown fox jumps over the lazy dog.
Hier kommt der Text hin. Nur ein Mustertext, bitte ersetzen. Fülltext. Dies ist ein Beispielinhalt.
Bitte ersetzen Sie diesen Platzhaltertext. Hier Text eingeben. Überschrift einfügen.
Escriba su texto aquí. Este es un texto de relleno. Sustituya este párrafo. Contenido de prueba.
Saisissez votre texte ici. Ceci est un faux texte. Remplacez ce paragraphe. Contenu provisoire.
"""

LATIN = "ad adipiscing aenean aliqua aliquam aliquip amet anim ante arcu at auctor augue aute bibendum blandit cillum commodo condimentum congue consectetur consequat convallis culpa cupidatat curabitur cursus dapibus deserunt diam dictum do dolor dolore donec duis ea egestas eget eiusmod elementum elit enim erat eros esse est et eu ex excepteur exercitation facilisis fames faucibus felis fermentum feugiat fringilla fugiat fusce gravida habitant hac iaculis id imperdiet in incididunt integer interdum ipsum irure justo labore laboris laborum lacinia lacus lectus leo libero ligula lobortis lorem luctus maecenas magna malesuada massa mattis mauris metus minim mollis mollit morbi nam nec neque nibh nisi nisl non nostrud nulla nullam nunc occaecat odio officia orci ornare pariatur pellentesque pharetra phasellus placerat porta praesent pretium proident proin pulvinar purus quam qui quis quisque reprehenderit rhoncus risus sagittis sapien scelerisque sed sem semper sint sit sollicitudin sunt suscipit suspendisse tellus tempor tempus tincidunt tortor tristique turpis ullamco ultrices urna ut varius vehicula vel velit veniam vestibulum vitae vivamus viverra voluptate vulputate"

#: Signs that open and close an unfilled slot, and what stands in it.
BRACKETS = "{{ }}|{{| }}|{{|}}|{{{|}}}|${|}|#{|}|{%|%}|{% | %}|<%|%>|<%= | %>|<%=|%>|<?=|?>|[[|]]|<<|>>|@@|@@|##|##|%%|%%|__|__|$$|$$|~~|~~|{|}|%|%|$(|)|@{|}|[%|%]|<|>|&lt;|&gt;|**|**|::|::|[|]|&lt;&lt;|&gt;&gt;|#|#|{{|"
PHRASES = """
[INSERT {fill}]
[Insert {fill} here]
[insert {fill}]
[Enter {fill}]
[add {fill} here]
[your {fill}]
[Your {fill} here]
[{fill} goes here]
[{fill} to be confirmed]
[{fill} to be provided]
[to be decided]
[choose {fill}]
[select one]
[missing {fill}]
[{fill} pending]
(insert {fill} here)
<insert {fill}>
<your {fill}>
<enter {fill} here>
<add {fill}>
&lt;{fill}&gt;
&lt;your {fill}&gt;
{object}.{name} is not set
TBD
TBC
TODO
TODO: add {fill}
FIXME
XXX
XXXX
XXXXX
{fill}: TBD
{fill}: TBC
{fill}: XXX
%s
%d
%(name)s
%({name})s
%1$s
{}
{0}
{1}
$1
:{name}
[object Object]
NaN
undefined
null
[null]
"""
BARE = ("NaN", "undefined", "null")
#: Where the trace of an empty value stands.
AROUND = """
Dear {trace},
Hello {trace}, thank you for your order.
by {trace} on {trace}
Updated on {trace}.
Page {trace} of {trace}
Take {trace} {unit} a day.
Give {trace} {unit} of {trace}.
in {trace} {unit}
of {trace} {unit} with
The {fill} is {trace}.
{fill}: {trace}
{fill} = {trace}
for {trace} and {trace}
contact {trace} for details
with {trace} ({trace})
see {trace}
to {trace} {unit} every {trace} {unit}
"""

#: Prose that speaks of such things, or has signs like theirs as notation.
PROSE = """
The web survey logged an error for some respondents, whose answers were then entered by hand.
Older adults found the error messages of the device hard to understand.
The website of the register was visited {n} times during the study, mostly for the leaflet.
Access to care was limited in rural areas, and many people could not be reached.
Requests for data should be sent to the corresponding author.
We looked at how cookies, browsers and scripts are used to track visits to health pages.
The placebo served as a placeholder for active treatment in the model.
A sample text of {n} words was read aloud by each child.
The function is undefined at zero, and the limit was taken instead.
The risk remains undefined in pregnancy. Patients with undefined fever were left out.
The score is undefined if no item was answered. An undefined mass was seen on the scan.
Null results were published less often. The null hypothesis was rejected. Null mutants grew slowly.
The set {{x, y, z}} has three members; interval [0, {n}) and matrix [a_ij] were used.
Concentrations <{n} ng/ml or >{n} ng/ml were left out; p<0.05 and P > 0.1.
We used [18F]FDG and [3H]thymidine; Ca2+ and Na+ rose by 5% [95% CI 2% to 9%].
Costs were $12 and $30 per visit; the code #12 was used for group {{A, B}}.
Genes such as TP53_1, XX and XY karyotypes and the XXX syndrome were reported [12,13].
Doses of 5 mg/kg/day were given to {n} of {n} patients (see Table 2 and Fig. 3).
The server room of the hospital was moved. A service for stroke was unavailable at night.
Sessions were missed by {n} patients who were not found at home.
Bei {n} Patienten war der Befund nicht verfügbar. Die Seite der Läsion wurde vermerkt.
En {n} pacientes no se encontró la lesión. El servicio no estaba disponible los domingos.
Chez {n} patients, la lésion n'a pas été trouvée. Le service était fermé la nuit.
"""

#: Natural use of signs: citations, mathematics, chemistry, genetics, statistics, markup, labels. {a} is a small letter, {A} a capital, {n} a number.
NOTATION = """
[{n}]
[{n},{n}]
[{n}-{n}]
[{n}% CI {n} to {n}]
[{n}%]
({n}%)
{n} %
{n}%/{n}%
[see {Part} ({n})]
[See {Part}]
[{A}{n}]
[{n}{A}]{word}
[{A}a2+]
[{A}+]
[{word}]
[sic]
[corrected]
[{word}, {n}]
[IQR {n}-{n}]
[mean {n}, SD {n}]
[{a},{a}]
[{a}; {a}]
[{a}_{a}]
[{word} {word}; {word}]
{{{a}, {a}, {a}}}
{{{n}, {n}}}
{{{a} : {a} > {n}}}
{{{word}, {word}}}
{{{word}; {word}; {word}}}
{{{word}-{word}}}
{{{word} {word}}}
{{{a} = {n}}}
{A}_{a}
{a}_{n}
{a}_{{{n}}}
{a}^{n}
{a}^{{{n}}}
{n}^{n}
10^{n}/L
{n}*10^{n}
{A}*{n}:{n}
{A}*{n}
*{n}
* p<0.{n}
**p < 0.{n}
<{n}
>{n}
< {n} mg
> {n} years
<={n}
p<0.{n}
P<.{n}
P < 0.{n}
{n}<{a}<{n}
{A}>{A}
{n}{A}>{A}
c.{n}{A}>{A}
&lt;{n}
&gt;{n} mg
&lt; 0.{n}
p&lt;0.{n}
&amp;
{A}&{A}
{A}&amp;{A}
{word} &amp; {word}
&nbsp;
&#{n};
${n}
US${n}
${n} to ${n}
${a}$
#{n}
No. #{n}
~{n}
~{n}%
|{a}|
|{a}-{a}|
{word} | {word} | {n}
| {n} | {n} |
{word}@{word}.org
{word}.{word}@{word}.edu
https://{word}.org/{word}_{word}#{a}{n}
{word}_{word}.txt
{A}{A}_{n}
<b>{word}</b>
<i>{word} {word}</i>
<sub>{n}</sub>
<sup>{n}</sup>
<br/>
<p>{word}</p>
<td>{n}</td>
{A}{A}{A}
XX
XY
XXY
XXX syndrome
factor XXX
phase XX
NaN3
{n} mM NaN3
{word}-null {word}
null {word}
undefined {word}
%CV
%ID/g
{word}%
%{word}
%{A}{A}{A}
{n}%{word}
\\{word}
\\{a}
$\\{word}$
$\\{word} = {n}$
$\\{word}{{{a}}}$
$\\{word}{{{a}}}{{{a}}}$
$\\{word}{{{a}_{{{n}}}}}{{{n}}}$
$\\{word}_{{{a}={n}}}^{{{a}}} {a}_{a}$
\\{word}{{{word}}}
\\begin{{{word}}}
${a}_{{{a},{a}}}$
${a}_{a}$
${a} < {n}$
${a}^{{{n}}}$
$\\{word}{{{word}}} = {n}$
{n}-{{{n}-[{word}({word})]}}{word}
{{[{n}-({word})]{word}}}
[({n}{A})-{n}-{word}]
{A}[{A}@{A}]({A}){A}
{A}{a}[{n}]
#{word}
@{word}
<https://{word}.org/{n}>
hsa_{word}_{n}
{{{word}|{word}}}
{{{word}/{word}}}
{{{word}: {word}}}
{{{word} per {word}}}
{{see {word}}}
{{{A}}}
{{{a}|{a}}}
[{word}/{word}]
[{word}: {n}]
<{word}>
{word} < {word}
{word} <-> {word}
{word} -> {word}
{word}={n}; {word}={n}
(*{word})
{word}*
`{word}`
"""
WORDS = "insulin|renal|placebo|control|treated|missed|late|early|serum|plasma|dose|mean|range|group|person|year|liver|cell|protein|acute|chronic|high|low|female|male|infant|adult|tumour|baseline|week|glucose|pressure|heart|oral|daily|normal|sodium|calcium|kinase|receptor|mouse|rat|trial|cohort|risk|case|event|yes|no|other|none|never|always"
PARTS = "Warnings and Precautions|Dosage and Administration|Contraindications|Adverse Reactions|Clinical Pharmacology|Use in Specific Populations|Drug Interactions|Table|Figure|Methods|Appendix"
SPOKEN = """
the value {x} was used
in {x} of the cases
with {x} and {x}
{x}, as reported before {x}.
as shown {x}, the
was {x} in {word} and {x} in {word}
({x})
for {x} the {word}
{word} {x} {word}
"""

_SLOT = re.compile(r"\{(\w+)\}")


def _fill(rng: np.random.Generator, template: str, extra: dict[str, list[str]] | None = None) -> str:
    """The template with its slots filled by seeded draws; doubled braces are single ones."""
    hidden = template.replace("{{", "\x01").replace("}}", "\x02")

    def draw(m: re.Match) -> str:
        choices = (extra or {}).get(m.group(1)) or SLOTS.get(m.group(1), "").split("|")
        return str(rng.choice(choices)) if choices != [""] else m.group(0)

    return _SLOT.sub(draw, hidden).replace("\x01", "{").replace("\x02", "}")


def _cased(rng: np.random.Generator, text: str) -> str:
    """Mostly as written, at times all small, all capital or each word capital."""
    way = rng.integers(10)
    return text.lower() if way == 0 else text.upper() if way == 1 else text.title() if way == 2 else text[:1].upper() + text[1:]


def _lines(block: str) -> list[str]:
    return block.strip().splitlines()


def notices(rng: np.random.Generator, each: int = 30, block: str = NOTICE) -> list[str]:
    return [_cased(rng, _fill(rng, t)) for t in _lines(block) for _ in range(each)]


def filler(rng: np.random.Generator, each: int = 20, block: str = FILLER, rules: bool = True) -> list[str]:
    out = [_cased(rng, _fill(rng, t)) for t in _lines(block) for _ in range(each)]
    if not rules:
        return out
    latin = LATIN.split()
    for _ in range(40 * each):
        ws = rng.choice(latin, rng.integers(6, 14)).tolist()
        out.append(_cased(rng, ("Lorem ipsum " if rng.random() < 0.2 else "") + " ".join(w + ("," if rng.random() < 0.1 else "") for w in ws) + "."))
    rows = ["qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertz", "azerty", string.ascii_lowercase, "12345678"]
    few = ["test", "foo", "bar", "baz", "blah", "bla", "xyz", "abc", "lorem", "dummy", "sample", "text", "testing", "aaa", "xxx", "123", "hello world", "asdf", "qwer", "jkl"]
    for _ in range(10 * each):
        key = lambda: (lambda r, a: r[a : a + rng.integers(3, 7)])(str(rng.choice(rows)), rng.integers(0, 4))
        out += [" ".join(key() for _ in range(6)), " ".join([str(rng.choice(few))] * int(rng.integers(3, 7))), " ".join(rng.choice(few, 7))]
    return out


def _slot(rng: np.random.Generator, block: str, only: bool) -> str:
    """One unfilled slot: a name in some case between signs, or a phrase."""
    if only or rng.random() < 0.45:
        return _fill(rng, str(rng.choice(_lines(block))).replace("{}", "{{}}").replace("{0}", "{{0}}").replace("{1}", "{{1}}"))
    marks = BRACKETS.split("|")[1:]
    at = 2 * int(rng.integers(0, len(marks) // 2))
    name = _fill(rng, str(rng.choice(["{name}", "{name}", "{object}.{name}", "{object}_{name}", "{name}|{filter}", "{name} | {filter}", "{fill}", "if {name}", "end{object}", "{object}['{name}']"])))
    way = rng.integers(4)
    name = name.upper() if way == 0 else re.sub(r"[_ ](\w)", lambda m: m.group(1).upper(), name) if way == 1 else name
    return marks[at] + name + marks[at + 1]


def placeholders(rng: np.random.Generator, n: int = 9000, block: str = PHRASES, only: bool = False) -> list[tuple[str, list[tuple[int, int]]]]:
    """Texts and where in them the slots stand."""
    out, around = [], _lines(AROUND)
    for _ in range(n):
        slot = _slot(rng, block, only)
        frame = _fill(rng, str(rng.choice(around)).replace("{trace}", "\x03")) if rng.random() < 0.7 else "\x03"
        parts = frame.split("\x03")
        spans, at = [], 0
        for part in parts[:-1]:
            at += len(part)
            spans.append((at, at + len(slot)))
            at += len(slot)
        out.append((slot.join(parts), spans))
    return out


def notation(rng: np.random.Generator, n: int = 16000) -> list[str]:
    """Signs as notation, inside a few words."""
    forms, frames = _lines(NOTATION), _lines(SPOKEN)
    draw = lambda choices: str(rng.choice(choices))
    extra = lambda: {"a": list("abcijkmnpqrtxyz"), "A": list("ABCDEFGHKLMNPRSTVX"), "n": [str(rng.integers(1, 500))], "word": WORDS.split("|"), "Part": PARTS.split("|")}
    return [_fill(rng, draw(frames), extra() | {"x": [_fill(rng, draw(forms), extra())]}) for _ in range(n)]


def prose(rng: np.random.Generator, each: int = 20) -> list[str]:
    return [_fill(rng, t, {"n": [str(x) for x in rng.integers(2, 900, 8)]}) for t in _lines(PROSE) for _ in range(each)] + notation(rng)
